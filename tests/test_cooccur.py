"""corating_self_join returns every pair of movies with a shared user, not ten a movie."""

import pytest

from cinelake.operators import cooccur as C
from cinelake.plans.registry import load_all


def brute(rows):
    n = {}
    for u, a in rows:
        for w, b in rows:
            if u is not None and u == w and a is not None and b is not None and a != b:
                n[a, b] = n.get((a, b), 0) + 1
    out = []
    for a in {x for x, _ in n}:
        out += [(a, i + 1, b, c) for i, (b, c) in enumerate(sorted(((b, c) for (x, b), c in n.items() if x == a), key=lambda t: (-t[1], t[0])))]
    return sorted(out)


def shared(spark, rows, **options):
    return sorted(tuple(r) for r in C.shared_users(spark.createDataFrame(rows, "userId long, movieId long"), **options).collect())


def test_a_movie_of_many_partners_keeps_them_all(spark, tmp_path):
    spark.createDataFrame([(o, 1 + o % 3) for o in range(60)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    lines = spark.createDataFrame([(o, 100 + o // 2, 10.0, "1995-01-01") for o in range(60)], "l_orderkey long, l_partkey long, l_quantity double, l_shipdate string")
    lines.selectExpr("l_orderkey", "l_partkey", "l_quantity", "cast(l_shipdate as timestamp) AS l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = load_all()["corating_self_join"].spark(spark, str(tmp_path))
    assert set(got.columns) == {"movieId", "rank", "other", "n_shared"}
    assert sorted((r.movieId, r["rank"], r.other, r.n_shared) for r in got.collect()) == brute([(1 + o % 3, 100 + o // 2) for o in range(60)])
    assert got.groupBy("movieId").count().agg({"count": "max"}).first()[0] > 10


@pytest.mark.parametrize("pending", [5, 6_000_000])
def test_blocks_parts_repeats_nulls_and_wide_ids(spark, pending):
    small = {"entries": 7, "pairs_a_part": 40, "pending": pending}
    rows = [(u, m) for u in range(12) for m in range(20) if (u * 7 + m * m) % 3 == 0] + [(3, 4), (3, 4), (None, 1), (None, 2), (5, None), (99, 1)]
    assert shared(spark, rows, **small) == brute(rows)
    wide = [(u, None if m is None else (m - 7) * (1 << 40)) for u, m in rows]
    assert shared(spark, wide, **small) == brute(wide)


def test_no_ratings(spark):
    assert shared(spark, []) == []
