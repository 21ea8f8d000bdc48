"""svd_explained_variance has every component of the curve up to 128 that the matrix has, not 32."""

import numpy as np
import pytest

from cinelake.plans.registry import load_all


@pytest.mark.parametrize("nulls", [False, True])
def test_all_components_of_the_curve(spark, tmp_path, nulls):
    users, items = 90, 70
    rng = np.random.default_rng(8)
    cells = sorted({(int(u), int(m)) for u, m in zip(rng.integers(0, users, 2500), rng.integers(0, items, 2500))})
    quantity = rng.integers(1, 51, len(cells))
    orders = [(u, u) for u in range(users)] + [(1000, None)] * nulls
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    odd = [(1000, m, 50.0) for m in range(items)] + [(u, None, 50.0) for u in range(0, users, 2)]
    lines = spark.createDataFrame([(u, m, float(q)) for (u, m), q in zip(cells, quantity)] + odd * nulls, "l_orderkey long, l_partkey long, l_quantity double")
    lines.selectExpr("*", "timestamp'1995-01-01' AS l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    A = np.zeros((users, items))
    for (u, m), q in zip(cells, quantity):
        A[u, m] = 0.5 + 0.5 * ((q - 1) // 5)
    U, s, _ = np.linalg.svd(A, full_matrices=False)
    ratio = (U * s).var(axis=0) / A.var(axis=0).sum()
    got = load_all()["svd_explained_variance"].spark(spark, str(tmp_path)).orderBy("component").collect()
    assert [r.component for r in got] == list(range(1, items + 1))
    assert [r.singular_value for r in got] == pytest.approx(s, rel=1e-5)
    if not nulls:                                                    # all ratings count in the total
        assert [r.ratio for r in got] == pytest.approx(ratio, rel=1e-3, abs=2e-6)
        assert got[-1].cumulative_ratio == pytest.approx(1.0, abs=1e-5)
