"""Intra-list diversity of lists that share their movies, and the written fit data."""

import math

import pytest

from cinelake.operators import evaluate as V
from cinelake.plans import q_supervised as Q


def test_two_movies_of_many_lists_are_one_row(spark):
    genres = {1: "A|B", 2: "B|C|D", 3: "E", 4: None}
    movies = spark.createDataFrame(list(genres.items()), "movieId long, genres string")
    lists = {u: [1, 2, 3, 4] if u % 2 else [2, 1] for u in range(200)}
    recs = spark.createDataFrame([(u, r + 1, m) for u, ms in lists.items() for r, m in enumerate(ms)], "userId long, rank int, movieId long")
    users = spark.createDataFrame([(u,) for u in lists], "userId long")
    pairs = recs.selectExpr("userId", "rank r1", "movieId m1").join(recs.selectExpr("userId", "rank r2", "movieId m2"), "userId").where("r1 < r2")
    assert sorted(tuple(r) for r in V.shared_tokens(pairs, V.genre_vectors(movies)).select("m1", "m2", "n").collect()) == [(1, 2, 1), (2, 1, 1)]
    near = 1 - 1 / math.sqrt(6)
    want = ((near + 5) / 6 + near) / 2
    assert V.intra_list_diversity(recs, users, movies).first()["value"] == pytest.approx(want, abs=1e-12)


def test_fit_reads_written_features(spark, sf):
    train, _ = Q._fit_data(spark, sf)
    assert train.inputFiles() and all("train-features" in f for f in train.inputFiles())
