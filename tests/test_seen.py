"""Seen sets as bitmaps against Python sets, and onboarding with long histories."""

import random


from cinelake.operators import popularity as P
from cinelake.operators import seen as B


def test_bitmaps_equal_sets(spark):
    rng = random.Random(3)
    pairs = [(u, rng.choice([rng.randrange(1, 200), rng.randrange(32_700, 32_800), rng.randrange(10**9, 10**9 + 70_000), -rng.randrange(0, 70_000)]))
             for u in range(12) for _ in range(150)]
    df = spark.createDataFrame(pairs + pairs[:50] + [(None, 5), (3, None)], "userId long, movieId long").repartition(5)
    maps = B.seen_bitmaps(df)
    got = {}
    for r in B.seen_lists(maps).collect():
        assert r["items"] == sorted(r["items"]) and len(r["items"]) <= 32_768
        got.setdefault(r.userId, set()).update(r["items"])
    want = {}
    for u, m in pairs:
        want.setdefault(u, set()).add(m)
    assert got == want
    asked = [(rng.randrange(14), rng.choice(pairs)[1] + rng.choice([0, 0, 1])) for _ in range(400)] + [(None, 4), (2, None)]
    marked = B.is_seen(spark.createDataFrame(asked, "userId long, movieId long"), maps)
    assert sorted(((r.userId, r.movieId, r.is_seen) for r in marked.collect()), key=str) == sorted(
        ((u, m, m in want.get(u, set())) for u, m in asked), key=str)
    few = [m for _, m in pairs[:30]] + [77, 78]
    left = B.unseen_counts(maps, df.select("userId").where("userId is not null").distinct(), spark.createDataFrame([(m,) for m in few], "movieId long"))
    assert {r.userId: r.n_unseen for r in left.collect()} == {u: len(set(few) - s) for u, s in want.items()}


def test_a_set_is_as_small_as_its_items(spark):
    """Ids far apart: a row of 8 bytes an item, not a bucket of 4,096."""
    pairs = spark.range(300).selectExpr("id % 3 as userId", "id * 40000 as movieId")
    maps = B.seen_bitmaps(pairs)
    assert dict(maps.dtypes)["seen"] == "bigint" and maps.count() == 300
    dense = B.seen_bitmaps(spark.range(1, 32_769).selectExpr("1 as userId", "id as movieId"))
    assert dense.count() == 512 and B.seen_lists(dense).first()["items"] == list(range(1, 32_769))


def plain_onboarding(genres, buckets, excluded, k):
    taken, r = [], 0
    while len(taken) < k and any(r < len(buckets.get(g, [])) for g in genres):
        row = dict.fromkeys(buckets[g][r] for g in genres if r < len(buckets.get(g, [])))
        taken += [m for m in row if m not in excluded and m not in taken]
        r += 1
    return taken


def test_onboarding_with_a_long_history(spark):
    rng = random.Random(8)
    movies = [(i, f"m{i}", "|".join(rng.sample(["A", "B", "C"], rng.randint(1, 3)))) for i in range(1, 901)]
    ratings = [(u, m, float(rng.randrange(1, 11)) / 2) for u in range(40) for m in rng.sample(range(1, 901), 60)]
    mdf = spark.createDataFrame(movies, "movieId long, title string, genres string")
    rdf = spark.createDataFrame(ratings, "userId long, movieId long, rating double")
    requests = [(i, rng.sample(["A", "B", "C", "none"], rng.randint(1, 3))) for i in range(200)]
    long = rng.sample(range(1, 901), 700)
    exclude = [(5, m) for m in long] + [(i, rng.randrange(1, 901)) for i in range(0, 200, 3) for _ in range(4)]
    qdf = spark.createDataFrame(requests, "req_id long, genres array<string>")
    edf = spark.createDataFrame(exclude, "req_id long, movieId long").distinct()
    places = P.genre_places(mdf, rdf)
    met = P.open_places(qdf, places, edf, 5)
    assert met.count() < 3 * (200 * (5 + 4) + 705)                        # own exclusions and k, not the longest history of all
    buckets = {}
    for r in places.orderBy("genre", "pos").collect():
        buckets.setdefault(r.genre, []).append(r.movieId)
    got = {}
    for r in P.genre_onboarding(qdf, mdf, rdf, k=5, exclude=edf).orderBy("req_id", "rank").collect():
        got.setdefault(r.req_id, []).append(r.movieId)
    gone = {}
    for i, m in exclude:
        gone.setdefault(i, set()).add(m)
    for i, genres in requests:
        want = plain_onboarding(genres, buckets, gone.get(i, set()), 5)
        if want:
            assert got[i] == want
        else:
            assert len(got[i]) == 5                                         # the popular ones instead
    assert set(got) == {i for i, _ in requests}
