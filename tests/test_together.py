"""Model comparisons: independent parts run at the same time, a longer list's candidates serve a shorter one."""

import threading

import numpy as np
import pytest

from cinelake.operators import latent as L
from cinelake.operators import neighbors as N
from cinelake.session import together
from cinelake.sources import store as ST

RATINGS = [(u, m, float(1 + (u * m) % 5)) for u in range(1, 13) for m in range(1, 31) if (u + m) % 4]


def made_up_model(spark):
    factors = lambda ids, name: spark.createDataFrame([(i, j, ((i * 7 + j * 5) % 11 - 4) / 3) for i in ids for j in range(4)], f"{name} long, j int, v double")
    return L.SvdModel(factors(range(1, 13), "userId"), factors(range(1, 31), "movieId"), np.ones(4), 3.0, 4)


def test_parts_run_at_the_same_time(spark):
    both = threading.Barrier(2, timeout=30)                         # breaks if one part waits for the other

    def part(n):
        both.wait()
        return spark.range(n).count()
    assert together(spark, lambda: part(3), lambda: part(5)) == [3, 5]


def test_a_failing_part_is_raised(spark):
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: spark.range(3).count(), lambda: 1 // 0)


def test_shorter_lists_from_the_candidates_of_longer_ones(spark):
    ratings = spark.createDataFrame(RATINGS, "userId long, movieId long, rating double")
    movies = spark.createDataFrame([(m, f"T{m}", "A|B" if m % 3 else "C") for m in range(1, 31)], "movieId long, title string, genres string")
    vecs = spark.createDataFrame([(m, f"t{m % j}", 1.0 + j / m) for m in range(1, 31) for j in (2, 3, 7)], "id long, term string, w double")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    model = made_up_model(spark)
    users = ratings.select("userId").distinct().where("userId > 3")
    assert rows(L.svd_recommend(ratings, model, 3, users, L.svd_candidates(ratings, model, 9, users))) == rows(L.svd_recommend(ratings, model, 3, users))
    found = N.profile_candidates(ratings, movies, None, 9, vecs)
    assert rows(N.recommend_from_profile(ratings, movies, None, 3, vecs, found)) == rows(N.recommend_from_profile(ratings, movies, None, 3, vecs))
    assert rows(N.recommend_from_profile(ratings, movies, None, 9, vecs, found)) == rows(N.recommend_from_profile(ratings, movies, None, 9, vecs))


def test_pipeline_fits_and_recommends_in_parallel_parts(spark, monkeypatch, tmp_path):
    """the SVD channel does not wait for the content channel, in fit and in recommend."""
    ratings = spark.createDataFrame(RATINGS, "userId long, movieId long, rating double")
    movies = spark.createDataFrame([(m, f"T{m}", "A|B" if m % 3 else "C") for m in range(1, 31)], "movieId long, title string, genres string")
    cfg = ST.PipelineConfig(n_svd_components=4)
    monkeypatch.setattr(L, "svd_fit", lambda *_, **__: made_up_model(spark))
    for a, b in (("svd_fit", "content_vectors"), ("svd_recommend", "recommend_from_profile")):
        met = threading.Barrier(2, timeout=60)
        for module, name in ((L, a), (N, b)):
            def waits(*args, _plain=getattr(module, name), _met=met, **options):
                _met.wait()
                return _plain(*args, **options)
            monkeypatch.setattr(module, name, waits)
    bundle = ST.fit_pipeline(ratings, movies, None, str(tmp_path / "bundle"), cfg)
    assert ST.pipeline_recommend(bundle, 3, cfg).groupBy("userId").count().count() == 12
