import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])     # for the Python workers

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cinelake.session import build_session
    s = build_session(master="local[8]", shuffle_partitions=4, app_name="cinelake-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF001
