"""The top-k with upper bounds against all pairs."""

import numpy as np
import pytest

from cinelake.operators import pruned as P


def vectors(rng, n, dense, rare, base=0):
    """n ids with a few of ``dense`` common terms around some centres and rare ones."""
    centres = [rng.choice(dense, 4, replace=False) for _ in range(9)]
    out = {}
    for i in range(n):
        v = {f"d{t}": round(float(rng.uniform(0.5, 1.5)), 3) for t in centres[i % 9]}
        v.update({f"r{t}": 0.25 for t in rng.choice(rare, 3)})
        if i % 11 == 0:
            v = {f"d{t}": 1.0 for t in centres[i % 9]}                # ties
        out[base + i] = v
    return out


def brute(seeds, items, k, exclude=(), exclude_self=True, normalize=True):
    def unit(v):
        n = np.sqrt(sum(x * x for x in v.values())) if normalize else 1.0
        return {t: x / n for t, x in v.items() if x} if n else {}
    items = {i: unit(v) for i, v in items.items()}
    out = []
    for s, v in seeds.items():
        v = unit(v)
        sims = [(-round(sum(x * w.get(t, 0.0) for t, x in v.items()), 12), i) for i, w in items.items()
                if not (exclude_self and i == s) and (s, i) not in exclude]
        out += [(s, r + 1, i, -x) for r, (x, i) in enumerate(sorted(x for x in sims if x[0] < 0)[:k])]
    return sorted(out)


def table(spark, vecs):
    rows = [(i, t, w) for i, v in vecs.items() for t, w in v.items()]
    return spark.createDataFrame(rows, "id long, term string, w double").repartition(4)


def got(df):
    return sorted((r.sid, r["rank"], r.iid, r.sim) for r in df.collect())


def same(a, b):
    assert [x[:3] for x in a] == [x[:3] for x in b]
    assert np.allclose([x[3] for x in a], [x[3] for x in b], atol=2e-12)


@pytest.mark.parametrize("rows_a_block, hot_rows", [(40, 10**6), (1000, 10**6), (25, 30)])
def test_same_side(spark, rows_a_block, hot_rows):
    rng = np.random.default_rng(rows_a_block)
    vecs = vectors(rng, 230, 14, 400)
    vecs[500] = {f"r{t}": 1.0 for t in range(60)}                       # many entries: beyond hot_rows
    vecs[501] = {"alone": 1.0}
    v = table(spark, vecs)
    same(got(P.pruned_topk(v, v, 7, rows_a_block=rows_a_block, hot_rows=hot_rows)), brute(vecs, vecs, 7))


def test_doubled_entries_zero_weights_and_counts(spark):
    rows = [(1, 5, 1.0), (1, 5, 1.0), (1, 6, 0.0), (2, 5, 1.0), (2, 6, 1.0), (3, 6, 2.0), (4, 7, 0.0), (None, 5, 1.0), (5, None, 1.0), (6, 5, None)]
    v = spark.createDataFrame(rows, "id long, term long, w double")
    assert got(P.pruned_topk(v, v, 3, normalize=False)) == [(1, 1, 2, 2.0), (2, 1, 1, 2.0), (2, 2, 3, 2.0), (3, 1, 2, 2.0)]
    none = spark.createDataFrame([], "id long, term long, w double")
    assert got(P.pruned_topk(none, none, 3)) == [] and got(P.pruned_topk(v, none, 3)) == []


@pytest.mark.parametrize("rows_a_block", [30, 500])
def test_two_sides_with_exclusions(spark, rows_a_block):
    rng = np.random.default_rng(9)
    items, seeds = vectors(rng, 150, 12, 90), vectors(rng, 70, 12, 90, base=40)
    seeds[900] = {"unknown": 3.0, "d1": 1.0}
    pairs = {(int(s), int(i)) for s in seeds for i in rng.choice(150, 25)}
    pairs |= {(45, i) for i in range(150)}                               # one seed has seen all
    exclude = spark.createDataFrame(sorted(pairs), "sid long, iid long")
    s, i = table(spark, seeds), table(spark, items)
    same(got(P.pruned_topk(s, i, 5, exclude=exclude, exclude_self=False, rows_a_block=rows_a_block)),
         brute(seeds, items, 5, pairs, exclude_self=False))


def test_runs_are_left_out(spark):
    """Ids in clusters that share no heavy terms: most runs are never scored,
    and ten times the ids take far less than a hundred times the cells."""
    def cells(n):
        rng = np.random.default_rng(1)
        vecs = {i: {**{f"c{i % (n // 20)}-{j}": 1.0 for j in range(4)}, **{f"g{t}": float(rng.uniform(0.05, 0.1)) for t in rng.choice(8, 3, replace=False)}} for i in range(n)}
        v = table(spark, vecs)
        found = P.candidates(v, v, 5, rows_a_block=256)
        return P.pruned_share(found).first(), vecs, found
    (small, vecs, _), (large, _, _) = cells(200), cells(2000)
    assert large["pruned"] > 0.8 and large["scored"] < 30 * small["scored"]
    v = table(spark, vecs)
    same(got(P.pruned_topk(v, v, 5, rows_a_block=64)), brute(vecs, vecs, 5))


def test_hash_collision_numbers_by_rank(spark, monkeypatch):
    """Terms whose hashes collide are numbered by rank."""
    from pyspark.sql import functions as F
    rows = [(1, "a", 1.0), (2, "b", 1.0), (3, "a", 1.0)]
    v = spark.createDataFrame(rows, "id long, term string, w double")
    monkeypatch.setattr(P.F, "xxhash64", lambda c: F.lit(7).cast("bigint"))
    assert got(P.pruned_topk(v, v, 3)) == [(1, 1, 3, 1.0), (3, 1, 1, 1.0)]


def test_candidates_do_not_grow_with_the_blocks(spark):
    """A seed's best are kept over all item blocks: k candidates a seed, not k a pair of blocks."""
    rng = np.random.default_rng(4)
    items, seeds = vectors(rng, 300, 12, 90), vectors(rng, 60, 12, 90, base=1000)
    s, i = table(spark, seeds), table(spark, items)
    found = P.candidates(s, i, 5, exclude_self=False, rows_a_block=20)
    assert found.where("iid is not null").count() <= 5 * len(seeds)
    same(got(P.pruned_topk(s, i, 5, exclude_self=False, rows_a_block=20)), brute(seeds, items, 5, exclude_self=False))
