"""Spark session factory and small session-level helpers.

Library code never creates a session of its own: every operator takes the
caller's ``SparkSession`` (the driver's, a cluster's, or the test one built
here).  ``build_session`` is only for tests, ``bench.py`` and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Conf applied to sessions we create.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones; the session time
# zone is pinned so that event-time windows do not depend on the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "cinelake", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("CINELAKE_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("CINELAKE_DRIVER_MEM", "16g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            d = None
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint folder; create a scratch one only if unset
    (local tests).  On a cluster the setting always points to shared storage."""
    d = checkpoint_dir(spark)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local[") and master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cinelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:
        pass
    return d


def cut_lineage(df):
    """Materialise a frame that several later stages read (reliable checkpoint
    into the shared checkpoint folder, never ``localCheckpoint``): it is
    computed once, and a lost executor re-reads the files instead of
    recomputing the whole lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def together(spark: SparkSession, *parts):
    """The results of ``parts``, functions without arguments that need nothing of
    each other: their jobs run at the same time, each in a thread of its own."""
    with ThreadPoolExecutor(len(parts)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(p)) for p in parts]
        return [w.result() for w in waiting]


def written(df, name: str):
    """``df`` written once as Parquet to the shared checkpoint folder and read
    back: later jobs read only the columns they use, lost executors reread."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
