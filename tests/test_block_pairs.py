"""Pairs of blocks of dense vectors: every copy of an excluded id is left out, no block is shuffled."""

import numpy as np

from cinelake.operators import mips as M
from cinelake.operators import neighbors as N


def test_every_copy_of_an_excluded_id_is_left_out(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 9)] * 2
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    own = spark.createDataFrame([(i, i) for i in range(1, 9)], "sid long, iid long")
    got = M.inner_product_topk(df, df, 3, own, items_a_block=4, seeds_a_block=4).collect()
    assert len(got) == 24 and all(r.sid != r.iid for r in got)


def test_many_excluded_ids_split_a_block(spark, monkeypatch):
    monkeypatch.setattr(M, "GONE", 10)
    df = spark.createDataFrame([(i, [float(i), -1.0]) for i in range(20)], "id long, vec array<double>")
    gone = {(s, i) for s in range(20) for i in range(20) if (s + i) % 4 == 0 or s == 3}
    got = M.inner_product_topk(df, df, 4, spark.createDataFrame(sorted(gone), "sid long, iid long")).collect()
    want = [(s, i) for s in range(20) for i in sorted((x for x in range(20) if (s, x) not in gone), key=lambda x: (-(s * x + 1), x))[:4]]
    assert sorted((r.sid, r["rank"], r.iid) for r in got) == sorted((s, n % 4 + 1, i) for n, (s, i) in enumerate(want))


def test_embedding_neighbours_equal_all_pairs_without_copied_blocks(spark, monkeypatch):
    def copied(*args, **options):
        raise AssertionError("blocks are copied once for every block of the other side")
    monkeypatch.setattr(N, "blocked_topk", copied)
    rng = np.random.default_rng(3)
    vecs = {i: np.round(rng.normal(size=5), 2) for i in range(60)}
    rows = [(i, [float(x) for x in v]) for i, v in vecs.items()] + [(7, [1.0, 0.5]), (90, [0.0] * 5), (91, None), (92, [None, 2.0])]
    vecs[7] = vecs[7] + np.array([1.0, 0.5, 0, 0, 0])
    vecs[92] = np.array([0.0, 2.0, 0, 0, 0])
    unit = {i: v / np.linalg.norm(v) for i, v in vecs.items()}
    got = N.embedding_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5).collect()
    want = [(s, n + 1, i) for s in unit for n, i in enumerate(sorted((x for x in unit if x != s), key=lambda x: (-round(float(unit[s] @ unit[x]), 12), x))[:5])]
    assert sorted((r.seed, r["rank"], r.neighbour) for r in got) == sorted(want)
