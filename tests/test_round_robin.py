"""The interleaving of genre buckets against a plain loop."""

from cinelake.operators import popularity as P
from cinelake.plans.registry import load_all


def test_merge_of_buckets(spark):
    requests = spark.createDataFrame([(1, ["A", "B"]), (2, ["B", "A", "B"]), (3, ["none"])], "req_id long, genres array<string>")
    buckets = spark.createDataFrame([("A", 10, 5.0, 1), ("A", 11, 4.0, 2), ("A", 12, 3.0, 3), ("B", 11, 4.0, 1), ("B", 10, 5.0, 2)],
                                    "genre string, movieId long, score double, pos long")
    got = P.round_robin_merge(P.first_places(requests, buckets), 3)
    assert sorted((r.req_id, r.pos, r.gpos, r.movieId) for r in got.collect()) == [(1, 1, 0, 10), (1, 1, 1, 11), (1, 3, 0, 12),
                                                                                   (2, 1, 0, 11), (2, 1, 1, 10), (2, 3, 1, 12)]


def test_registered_query_runs(spark, sf):
    out = load_all()["round_robin_merge"].spark(spark, sf)
    assert out.columns == ["req_id", "rank", "movieId", "round"]
    best = {}
    for r in out.collect():
        best.setdefault(r.req_id, []).append(r["rank"])
    assert best and all(sorted(v) == list(range(1, len(v) + 1)) for v in best.values())
