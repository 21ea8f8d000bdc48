"""SVD against NumPy, KS against an independent computation."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinelake.operators import latent as L
from cinelake.operators import monitor as T


def test_svd_recovers_low_rank_matrix(spark):
    rng = np.random.default_rng(0)
    U = rng.random((40, 3))
    V = rng.random((3, 30))
    X = U @ V
    rows = [(i, j, float(X[i, j])) for i in range(40) for j in range(30)]
    r = spark.createDataFrame(rows, "userId long, movieId long, rating double")
    m = L.svd_fit(r, k=3, oversample=5, n_iter=2)
    s = np.linalg.svd(X, compute_uv=False)[:3]
    assert np.allclose(m.singular_values, s, rtol=1e-6)
    pairs = spark.createDataFrame([(1, 2), (5, 7), (999, 1)], "userId long, movieId long")
    pred = {(p.userId, p.movieId): p.prediction for p in L.svd_predict(pairs, m).collect()}
    assert pred[(1, 2)] == pytest.approx(min(5.0, max(0.5, X[1, 2])), rel=1e-6)
    assert pred[(999, 1)] == pytest.approx(float(X.mean()))          # unknown user -> global mean


def test_svd_recommend_excludes_seen(spark):
    rng = np.random.default_rng(1)
    rows = [(u, int(m), float(rng.integers(1, 6))) for u in range(20) for m in rng.choice(25, 8, replace=False)]
    r = spark.createDataFrame(rows, "userId long, movieId long, rating double")
    model = L.svd_fit(r, k=4)
    recs = L.svd_recommend(r, model, k=5).collect()
    seen = {(u, m) for u, m, _ in rows}
    assert recs and all((x.userId, x.movieId) not in seen for x in recs)


def _ks_numpy(a, b):
    a, b = np.sort(a), np.sort(b)
    xs = np.union1d(a, b)
    fa = np.searchsorted(a, xs, side="right") / len(a)
    fb = np.searchsorted(b, xs, side="right") / len(b)
    d = np.max(np.abs(fa - fb))
    lam = d * math.sqrt(len(a) * len(b) / (len(a) + len(b)))
    p = 1.0 if lam < 0.2 else min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam)
                                                        for k in range(1, 101))))
    return d, p


def test_ks_matches_numpy(spark):
    rng = np.random.default_rng(2)
    a = rng.choice([1.0, 2.0, 3.0, 4.0, 5.0], 300)
    b = rng.choice([3.0, 4.0, 5.0], 80)
    base = spark.createDataFrame([(float(x),) for x in a], "rating double")
    live = spark.createDataFrame([(float(x),) for x in b], "rating double")
    got = T.ks_drift(base, live).first()
    d, p = _ks_numpy(a, b)
    assert got.ks_statistic == pytest.approx(d)
    assert got.p_value == pytest.approx(p, abs=1e-9)
    assert got.drift_detected == (p < 0.05) and got.status == "SUCCESS"


def test_ks_insufficient_live_data(spark):
    base = spark.createDataFrame([(4.0,), (4.5,), (5.0,)], "rating double")
    live = spark.createDataFrame([(4.0,), (3.5,)], "rating double")
    got = T.ks_drift(base, live).first()
    assert got.status == "INSUFFICIENT_DATA" and got.p_value == 1.0 and got.ks_statistic == 0.0
    assert got.drift_detected is False


def test_latency_summary_empty_is_zero(spark):
    e = spark.createDataFrame([], "latency_ms double")
    got = T.latency_summary(e).first()
    assert (got.p50, got.p95, got.p99, got.mean) == (0.0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("n1,n2", [(3, 4), (4, 6), (5, 5), (2, 9)])
def test_exact_ks_p_by_enumeration(n1, n2):
    from itertools import combinations
    far = []
    for c in combinations(range(n1 + n2), n1):
        steps = np.isin(np.arange(n1 + n2), c)
        far.append(np.abs(np.cumsum(steps) / n1 - np.cumsum(~steps) / n2).max())
    far = np.array(far)
    for d in sorted({round(x, 12) for x in far}):
        assert T.exact_ks_p(d, n1, n2) == pytest.approx((far >= d - 1e-9).mean())


def test_exact_p_replaces_the_series_for_small_samples(spark, sf):
    from cinelake.plans.registry import load_all
    from cinelake.sources import tables as S
    stat = T.ks_statistic(S.rating_feed(spark, sf).where("event_type = 'view'"),
                          T.daily_windows(S.rating_feed(spark, sf).where("event_type = 'purchase'")), "rating", group="day")
    want = {r.day: T.exact_ks_p(r.D, min(r.n_base, r.n_live), max(r.n_base, r.n_live)) for r in stat.collect() if r.n_live >= 3}
    got = {r.day: r for r in load_all()["rating_drift_exact"].spark(spark, sf).collect()}
    assert want and all(got[d].p_value == pytest.approx(p, abs=1e-6) and got[d].drift_detected == (p < 0.05) for d, p in want.items())
