"""Hand-computed values on tiny tables."""

import math
import os

import pytest
from pyspark.sql import functions as F

from cinelake.operators import evaluate as V
from cinelake.operators import neighbors as N
from cinelake.operators import prep as R


def test_tags_normalise_min_freq_keeps_duplicates(spark):
    rows = [(7, 3, " Slow Burn", 0), (8, 3, "slow burn ", 1), (9, 3, "SLOW BURN", 2), (7, 5, "heist", 3),
            (9, 5, "Heist", 4), (8, 6, "only once", 5)]
    t = spark.createDataFrame(rows, "userId long, movieId long, tag string, t long").withColumn(
        "ts", F.timestamp_seconds("t"))
    out = {r.movieId: r.combined_tags for r in R.load_tags(t, min_tag_freq=2).collect()}
    assert out == {3: "slow burn slow burn slow burn", 5: "heist heist"}


def test_null_tags_dropped(spark):
    t = spark.createDataFrame([(1, 10, None, 0), (2, 10, "x", 1)], "userId long, movieId long, tag string, t long"
                              ).withColumn("ts", F.timestamp_seconds("t"))
    assert R.normalise_tags(t).count() == 1


def test_interaction_matrix_shape(spark):
    from cinelake.operators.latent import interaction_index
    r = spark.createDataFrame([(4, 7, 2.5), (4, 8, 1.0), (6, 8, 4.0), (6, 9, 5.0), (9, 7, 3.0), (9, 9, 0.5)],
                              "userId long, movieId long, rating double")
    u, i = interaction_index(r)
    assert u.count() == 3 and i.count() == 3
    cells = r.join(u, "userId").join(i, "movieId").select("row_idx", "col_idx").distinct().count()
    assert cells == 6
    assert sorted(x.row_idx for x in u.collect()) == [0, 1, 2]


def _recs(spark, lists):
    rows = [(u, i + 1, m) for u, lst in lists.items() for i, m in enumerate(lst)]
    return spark.createDataFrame(rows, "userId long, rank int, movieId long")


def test_precision_recall_at_5(spark):
    recs = _recs(spark, {1: [1, 2, 3, 4, 5]})
    truth = spark.createDataFrame([(1, m) for m in (2, 4, 6, 8)], "userId long, movieId long")
    users = truth.select("userId").distinct()
    m = {(r.metric, r.k): r.value for r in V.ranking_metrics(recs, truth, users, ks=(5,)).collect()}
    assert m[("precision", 5)] == pytest.approx(2 / 5)
    assert m[("recall", 5)] == pytest.approx(2 / 4)
    # MAP: hits at ranks 2 and 4 -> (1/2 + 2/4) / min(4, 5)
    assert m[("map", 5)] == pytest.approx((0.5 + 0.5) / 4)


def test_perfect_ndcg(spark):
    recs = _recs(spark, {1: [1, 2, 3]})
    truth = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "userId long, movieId long")
    m = {(r.metric, r.k): r.value for r in
         V.ranking_metrics(recs, truth, truth.select("userId").distinct(), ks=(3,)).collect()}
    assert m[("ndcg", 3)] == pytest.approx(1.0)


def test_coverage_half(spark):
    recs = _recs(spark, {1: [1, 2], 2: [2, 3], 3: [4, 5]})
    users = recs.select("userId").distinct()
    cat = spark.createDataFrame([(10,)], "n_catalog long")
    v = V.coverage(recs, users, cat).first()["value"]
    assert v == pytest.approx(0.5)


MOVIES4 = [(1, "Toy Story (1995)", "Adventure|Animation|Children"), (2, "Jumanji (1995)", "Adventure|Children"),
           (3, "Heat (1995)", "Action|Crime|Thriller"), (4, "Casino (1995)", "Crime|Drama")]


def test_genre_recs_exclude_seed(spark):
    m = spark.createDataFrame(MOVIES4, "movieId long, title string, genres string")
    out = N.similar_by_genre(m, k=2).where("seed = 1").orderBy("rank").collect()
    assert len(out) == 2 and all(r.movieId != 1 for r in out)
    assert out[0].movieId == 2 and out[0].sim == pytest.approx(2 / math.sqrt(6))


def test_genre_recs_pad_with_zero_similarity(spark):
    m = spark.createDataFrame(MOVIES4, "movieId long, title string, genres string")
    out = N.similar_by_genre(m, k=3).where("seed = 2").orderBy("rank").collect()
    # only movie 1 shares a genre with movie 2; 3 and 4 pad with similarity 0 by id
    assert [r.movieId for r in out] == [1, 3, 4]
    assert [r.sim for r in out][1:] == [0.0, 0.0]


def test_temporal_split_small_history_stays_in_train(spark):
    rows = [(1, m, 4.0, m) for m in range(4)] + [(2, m, 3.0, m) for m in range(10)]
    r = spark.createDataFrame(rows, "userId long, movieId long, rating double, t long").withColumn(
        "ts", F.timestamp_seconds("t"))
    s = V.temporal_split_user(r).where("is_test").collect()
    assert {x.userId for x in s} == {2}
    assert sorted(x.movieId for x in s) == [8, 9]      # latest int(10 * 0.2) = 2 rows


def test_store_missing_bundle(spark, tmp_path):
    from cinelake.sources.store import load_model_tables
    with pytest.raises(FileNotFoundError):
        load_model_tables(spark, str(tmp_path / "nothing"))


def test_store_roundtrip_and_version(spark, tmp_path):
    from cinelake.sources.store import load_model_tables, save_model_tables
    df = spark.createDataFrame([(1, 2.0)], "movieId long, score double")
    save_model_tables(str(tmp_path / "b"), {"popularity": df})
    back = load_model_tables(spark, str(tmp_path / "b"))
    assert back["popularity"].collect()[0].score == 2.0
    save_model_tables(str(tmp_path / "c"), {"popularity": df}, version=2)
    with pytest.raises(ValueError, match="version 2"):
        load_model_tables(spark, str(tmp_path / "c"), version=1)


def test_store_resave_leaves_the_loaded_bundle_readable(spark, tmp_path):
    from cinelake.sources.store import load_model_tables, save_model_tables
    root = str(tmp_path / "b")
    save_model_tables(root, {"t": spark.createDataFrame([(1,)], "x long")})
    old = load_model_tables(spark, root)["t"]
    save_model_tables(root, {"t": spark.createDataFrame([(2,)], "x long")})
    assert [r.x for r in old.collect()] == [1]                       # a reader in the middle of a save
    assert [r.x for r in load_model_tables(spark, root)["t"].collect()] == [2]


def test_store_missing_table_and_legacy_manifest(spark, tmp_path):
    import json
    from cinelake.sources.store import load_model_tables, save_model_tables
    df = spark.createDataFrame([(1,)], "x long")
    root = str(tmp_path / "b")
    folder = save_model_tables(root, {"t": df})
    (tmp_path / "gone").mkdir()
    os.rename(f"{folder}/t", str(tmp_path / "gone" / "t"))
    with pytest.raises(ValueError, match="missing"):
        load_model_tables(spark, root)
    for name, manifest in (("legacy", json.dumps({"tables": ["t"]})), ("broken", "nothing")):
        spark.createDataFrame([("9", manifest)], "saved string, manifest string").write.json(str(tmp_path / name / "_manifests"))
        with pytest.raises(ValueError):
            load_model_tables(spark, str(tmp_path / name))


def test_links_csv_by_path_and_uri(spark, tmp_path):
    from cinelake.sources.tables import load_links_csv
    (tmp_path / "links.csv").write_text("movieId,imdbId,tmdbId\n1,2,3.0\n")
    for where in (str(tmp_path), f"file://{tmp_path}"):
        assert [tuple(r) for r in load_links_csv(spark, where).collect()] == [(1, 2, 3.0)]
    assert load_links_csv(spark, f"file://{tmp_path}/nowhere").count() == 0


def test_ks_from_counts_matches_pooled_grid(spark):
    import random

    from cinelake.operators.monitor import ks_statistic
    rnd = random.Random(2)
    base = [(round(rnd.gauss(0, 1), 1),) for _ in range(300)]
    live = [(g, round(rnd.gauss(g / 3, 1), 1)) for g in range(4) for _ in range(40 + g)]
    got = {r.g: r.D for r in ks_statistic(spark.createDataFrame(base, "v double"), spark.createDataFrame(live, "g int, v double"),
                                          "v", group="g").collect()}
    for g in range(4):
        own = [v for h, v in live if h == g]
        grid = sorted({v for v, in base} | set(own))
        want = max(abs(sum(v <= x for v, in base) / len(base) - sum(v <= x for v in own) / len(own)) for x in grid)
        assert got[g] == pytest.approx(want)


def test_stop_words_leave_no_contraction_tail(spark):
    from cinelake.operators.textfeat import term_counts
    df = spark.createDataFrame([(1, "We couldn't say they've seen what's here, I'll go; they'd don't film noir")], "id long, text string")
    assert {r.term for r in term_counts(df, "id", "text", 1).collect()} == {"say", "seen", "go", "film", "noir"}
