"""Every value of the model comparisons (E11, E13) from the lists themselves."""

import math
from itertools import combinations

import pytest

from cinelake.operators import evaluate as V
from cinelake.plans.registry import load_all

KS = (5, 10, 20)


def recomputed(lists, truth, train, movies, ks, k=10):
    """(metric, k) -> value, from per-user lists of movies."""
    out = {}
    for n in ks:
        p = r = a = g = 0.0
        for u, rel in truth.items():
            hits = [i for i, m in enumerate(lists.get(u, [])[:n], 1) if m in rel]
            p += len(hits) / n
            r += len(hits) / len(rel)
            a += sum((j + 1) / i for j, i in enumerate(hits)) / min(len(rel), n)
            g += sum(1 / math.log2(i + 1) for i in hits) / sum(1 / math.log2(i + 1) for i in range(1, min(len(rel), n) + 1))
        for name, x in (("precision", p), ("recall", r), ("map", a), ("ndcg", g)):
            out[name, n] = x / len(truth)
    top = {u: lists[u][:k] for u in truth if u in lists}
    out["coverage", k] = len({m for x in top.values() for m in x}) / max(1, len(movies))
    pop = {}
    for _, m in train:
        pop[m] = pop.get(m, 0) + 1
    news = [-math.log2(max(1e-9, pop.get(m, 1) / len(train))) for x in top.values() for m in x]
    out["novelty", k] = sum(news) / len(news) if news else 0.0
    sets = {m: set((g or "").lower().split("|")) for m, g in movies.items()}
    means = []
    for x in top.values():
        d = [1 - len(sets[a] & sets[b]) / math.sqrt(len(sets[a]) * len(sets[b])) for a, b in combinations([m for m in x if m in sets], 2)]
        if d:
            means.append(sum(d) / len(d))
    out["intra_list_diversity", k] = sum(means) / len(means) if means else 0.0
    return out


@pytest.mark.parametrize("key", ["benchmark_models", "component_ablation"])
def test_every_value(spark, sf, monkeypatch, key):
    seen = {}
    plain = V.evaluate_model

    def kept(recs, test, train, movies, model, threshold=4.0, sample_users=None, ks=V.DEFAULT_KS):
        lists = {}
        for r in recs.select("userId", "rank", "movieId").orderBy("userId", "rank").collect():
            lists.setdefault(r.userId, []).append(r.movieId)
        truth = {}
        for r in test.where(f"rating >= {threshold}").select("userId", "movieId").collect():
            truth.setdefault(r.userId, set()).add(r.movieId)
        seen[model] = recomputed(lists, truth, [(r.userId, r.movieId) for r in train.select("userId", "movieId").collect()],
                                 {r.movieId: r.genres for r in movies.collect()}, ks)
        return plain(spark.createDataFrame([(u, i + 1, m) for u, x in lists.items() for i, m in enumerate(x)], "userId long, rank int, movieId long"),
                     test, train, movies, model, threshold, sample_users, ks)
    monkeypatch.setattr(V, "evaluate_model", kept)
    rows = load_all()[key].fn(spark, sf).collect()
    got = {}
    for r in rows:
        got.setdefault(r.model, {})[r.metric, r.k] = r.value
    assert set(got) == set(seen) and len(got) >= 3
    for model, values in seen.items():
        assert got[model] == pytest.approx(values, abs=1e-9)
