"""Profiles against Python counts, sketches against the exact profile, binned PSI."""

import math
import random
from collections import Counter

import numpy as np

from cinelake.operators import eda as E
from cinelake.operators import monitor as T


def test_profile_of_any_table(spark):
    rows = [(i % 7, None if i % 5 == 0 else f"v{i % 4}", float(i) if i % 3 else None, i % 2 == 0) for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d boolean")
    got = {r.column_name: r for r in E.profile_columns({"t": df}).collect()}
    for j, (name, kind) in enumerate((("a", "integer"), ("b", "string"), ("c", "float"), ("d", "boolean"))):
        values = [r[j] for r in rows if r[j] is not None]
        show = lambda x: str(x).lower() if isinstance(x, bool) else str(x)
        top = sorted(Counter(map(show, values)).items(), key=lambda x: (-x[1], x[0]))[:5]
        r = got[name]
        assert (r.data_type, r.n_values, r.n_nulls, r.n_distinct) == (kind, len(values), 100 - len(values), len(set(values)))
        assert (r.min_value, r.max_value) == (show(min(values)), show(max(values)))
        assert r.top_values == ", ".join(f"{x} ({n})" for x, n in top)
    empty = E.profile_columns({"t": spark.createDataFrame([], "a int, b string")}).collect()
    assert [(r.n_values, r.n_distinct, r.min_value, r.top_values) for r in empty] == [(0, 0, None, None)] * 2


def test_sketches_keep_their_errors(spark):
    rng = random.Random(1)
    n = 60_000
    values = [int(rng.paretovariate(0.7)) % 10**7 for _ in range(n)]
    df = spark.createDataFrame([(v, f"s{v}") for v in values], "a long, b string").repartition(7)
    exact = {r.column_name: r for r in E.profile_columns({"t": df}).collect()}
    got = {r.column_name: r for r in E.sketch_columns({"t": df}).collect()}
    ordered = sorted(values)
    for c in ("a", "b"):
        assert got[c].n_values == n and abs(got[c].n_distinct / exact[c].n_distinct - 1) < 4 * 0.0081
        counts = Counter(str(v) if c == "a" else f"s{v}" for v in values)
        best = sorted(counts.values(), reverse=True)[:5]
        for r, want in zip(got[c].top, best):
            assert abs(r.n - counts[r.value]) <= 3.5 * n / 10_000 and abs(r.n - want) <= 3.5 * n / 10_000
    for p, x in ((0.25, got["a"].p25), (0.5, got["a"].p50), (0.75, got["a"].p75)):
        lo, hi = np.searchsorted(ordered, x, "left") / n, np.searchsorted(ordered, x, "right") / n
        assert lo - 0.007 <= p <= hi + 0.007
    assert got["b"].p50 is None


def test_binned_psi(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=1000), rng.normal(0.5, 1.2, size=700)
    frame = lambda x: spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    edges = sorted(a)
    edges = [edges[math.ceil(1000 * i / 10) - 1] for i in range(1, 10)]
    share = lambda x: np.maximum(np.bincount(np.searchsorted(edges, x, "left"), minlength=10) / len(x), 1e-4)
    want = (share(b) - share(a)) * np.log(share(b) / share(a))
    got = sorted((r.bin, r.upper, r.n_base, r.psi) for r in T.psi_binned(frame(a), frame(b), "x").collect())
    assert [g[1] for g in got] == [*edges, None] and {g[2] for g in got} == {100}
    assert np.allclose([g[3] for g in got], want)
    few = T.psi_binned(frame([1.0] * 50 + [2.0]), frame([1.0, 3.0]), "x").collect()       # ranks that fall on one value
    assert sorted((r.bin, r.upper, r.n_base, r.n_live) for r in few) == [(0, 1.0, 50, 1), (1, None, 1, 1)]
    none = T.psi_binned(frame([]), frame([]), "x").collect()
    assert [(r.n_base, r.n_live, r.psi) for r in none] == [(0, 0, 0.0)]
