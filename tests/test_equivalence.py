"""Window / blocked forms versus their definitions on random inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinelake.functions.ranking import first_k_unseen, global_rank
from cinelake.operators import hybrid as H
from cinelake.operators import popularity as P
from cinelake.operators.similarity import blocked_topk


def _reranked(cands, genres, k, penalty=0.15):
    """By definition: every candidate loses the penalty times the genres it shares
    with each better-ranked one, over its own number of genres."""
    order = sorted(cands, key=lambda m: (-cands[m], m))

    def score(m):
        better = order[:order.index(m)]
        shared = sum(len(genres[m] & genres[b]) for b in better)
        return max(0.0, cands[m] - penalty * shared / (len(genres[m]) + 1e-5))
    return sorted(((m, score(m)) for m in order), key=lambda x: (-round(x[1], 12), order.index(x[0])))[:k]


def test_diversity_rerank_matches_definition(spark):
    rnd = random.Random(7)
    names = list("ABCDEFG")
    movies = [(m, "|".join(rnd.sample(names, rnd.randint(1, 3)))) for m in range(60)]
    genres = {m: set(g.split("|")) for m, g in movies}
    rows = []
    for u in range(8):
        for m in rnd.sample(range(60), 25):
            rows.append((u, m, round(rnd.random(), 3)))
    fused = spark.createDataFrame(rows, "userId long, movieId long, base double")
    mdf = spark.createDataFrame(movies, "movieId long, genres string")
    got = H.diversity_rerank(fused, mdf, k=10).collect()
    for u in range(8):
        cands = {m: b for uu, m, b in rows if uu == u}
        exp = _reranked(cands, genres, 10)
        mine = sorted([r for r in got if r.userId == u], key=lambda r: r["rank"])
        assert [r.movieId for r in mine] == [m for m, _ in exp]
        assert [r.score for r in mine] == pytest.approx([s for _, s in exp])


def _round_robin(pref, buckets, k):
    """By definition: order all (position in its list, preference) pairs, keep the
    first occurrence of each item; only whole rounds are taken, until k are there."""
    cells = sorted((pos, i, m) for i, g in enumerate(pref) for pos, m in enumerate(buckets.get(g, ())))
    first = {}
    for pos, _, m in cells:
        first.setdefault(m, pos)
    items = list(first)
    if len(items) <= k:
        return items
    return [m for m in items if first[m] <= first[items[k - 1]]]


def test_round_robin_matches_definition(spark):
    rnd = random.Random(3)
    names = list("ABCDEF")
    movies = [(m, f"Movie {m} (1990)", "|".join(rnd.sample(names, rnd.randint(1, 3)))) for m in range(40)]
    ratings = [(u, m, float(rnd.choice([1.0, 2.0, 3.0, 4.0, 5.0])), 0) for u in range(30)
               for m in rnd.sample(range(40), 8)]
    mdf = spark.createDataFrame(movies, "movieId long, title string, genres string")
    rdf = spark.createDataFrame(ratings, "userId long, movieId long, rating double, t long").withColumn(
        "ts", F.timestamp_seconds("t"))
    reqs = [(i, rnd.sample(names, rnd.randint(1, 3))) for i in range(12)]
    qdf = spark.createDataFrame(reqs, "req_id long, genres array<string>")
    got = P.genre_onboarding(qdf, mdf, rdf, k=5).collect()
    pop = {r.movieId: r.score for r in P.bayesian_popularity(rdf).collect()}
    buckets = {}
    for m, _, g in movies:
        for x in set(g.split("|")):
            buckets.setdefault(x, []).append((m, pop.get(m, 0.0)))
    buckets = {g: [m for m, _ in sorted(v, key=lambda t: (-t[1], t[0]))] for g, v in buckets.items()}
    for rid, pref in reqs:
        exp = _round_robin(pref, buckets, 5)
        mine = [r.movieId for r in sorted([r for r in got if r.req_id == rid], key=lambda r: r["rank"])]
        assert mine == exp


def test_blocked_topk_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    n, d = 70, 12
    X = rng.random((n, d)) * (rng.random((n, d)) < 0.3)
    rows = [(i, j, float(X[i, j])) for i in range(n) for j in range(d) if X[i, j] != 0]
    v = spark.createDataFrame(rows, "id long, term long, w double")
    got = blocked_topk(v, v, 4, block_size=16).collect()      # several blocks per side
    norms = np.linalg.norm(X, axis=1)
    Xn = np.divide(X, norms[:, None], out=np.zeros_like(X), where=norms[:, None] > 0)
    S = Xn @ Xn.T
    for i in range(n):
        if norms[i] == 0:
            continue
        cand = [(round(S[i, j], 12), j) for j in range(n) if j != i and norms[j] > 0 and S[i, j] > 0]
        exp = [j for _, j in sorted(cand, key=lambda t: (-t[0], t[1]))[:4]]
        mine = [r.iid for r in sorted([r for r in got if r.sid == i], key=lambda r: r["rank"])]
        assert mine == exp


@pytest.mark.parametrize("same", [True, False])
def test_blocked_topk_splits_hot_ids(spark, same):
    """One id holds a third of all entries; it and others above the bound are
    scored by the term join, in several blocks and with exclusions."""
    rng = np.random.default_rng(9)
    n, d = 60, 300
    X = rng.random((n, d)) * (rng.random((n, d)) < 0.03)
    X[7] = rng.random(d)
    X[20, :80] = 1.0
    Y = X if same else rng.random((40, d)) * (rng.random((40, d)) < 0.05)
    if not same:
        Y[3] = 0.5

    def table(M):
        return spark.createDataFrame([(int(i), int(j), float(M[i, j])) for i, j in zip(*np.nonzero(M))], "id long, term long, w double")
    v = table(X)
    ex = [(7, 20), (20, 7), (1, 7), (2, 3)]
    exclude = spark.createDataFrame(ex, "sid long, iid long")
    got = blocked_topk(v, v if same else table(Y), 5, exclude=exclude, exclude_self=same, block_size=16, hot_rows=40).collect()
    A, B = (M / np.maximum(np.linalg.norm(M, axis=1, keepdims=True), 1e-300) for M in (X, Y))
    S = A @ B.T
    for i in range(n):
        cand = [(round(S[i, j], 12), j) for j in range(len(Y)) if S[i, j] > 0 and not (same and i == j) and (i, j) not in ex]
        want = [j for _, j in sorted(cand, key=lambda t: (-t[0], t[1]))[:5]]
        assert [r.iid for r in sorted((r for r in got if r.sid == i), key=lambda r: r["rank"])] == want


def test_first_k_unseen_matches_brute_force(spark):
    rnd = random.Random(11)
    seen = {u: set(rnd.sample(range(1, 40), rnd.randint(0, 20))) for u in range(15)}
    rows = [(u, r) for u, s in seen.items() for r in s]
    sdf = spark.createDataFrame(rows, "userId long, pop_rank long")
    users = spark.createDataFrame([(u,) for u in seen], "userId long")
    got = first_k_unseen(sdf, users, 6).collect()
    for u, s in seen.items():
        exp = [r for r in range(1, 100) if r not in s][:6]
        mine = [r.pop_rank for r in sorted([r for r in got if r.userId == u], key=lambda r: r["rank"])]
        assert mine == exp


def test_global_rank_is_dense(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 101).alias("x"), F.col("id"))
    r = global_rank(df, [F.col("x").desc(), F.col("id").asc()], partitions=5).collect()
    exp = sorted(((row.x, row.id) for row in r), key=lambda t: (-t[0], t[1]))
    assert [(row.x, row.id) for row in sorted(r, key=lambda row: row["rank"])] == exp
    assert sorted(row["rank"] for row in r) == list(range(1, 501))
