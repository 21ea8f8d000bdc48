"""Registered queries: model store, fitted pipeline, benchmark table, report,
personalisation lift and component ablation (S9, S10, S13, R14, E11-E13)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cinelake.operators import evaluate as V
from cinelake.operators import hybrid as H
from cinelake.operators import latent as L
from cinelake.operators import neighbors as N
from cinelake.operators import popularity as P
from cinelake.plans.q_evaluate import SPLIT_SQL, metrics_sql
from cinelake.plans.q_neighbors import UU_CTES, topk_sql
from cinelake.plans.registry import query
from cinelake.session import ensure_checkpoint_dir, together, written
from cinelake.sources import store as ST
from cinelake.sources import tables as S

REL_35 = 3.5   # relevance threshold of the canonical benchmark settings


def _bundle_root(spark, name):
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/bundles/{name}-{uuid.uuid4().hex[:8]}"


@query("model_store_roundtrip", code="S9/S10", floats=("mean_rating", "score"),
       sql="SELECT movieId, n_ratings, mean_rating, score FROM pop")
def q_model_store(spark, sf):
    r, m = S.interactions(spark, sf), S.movies(spark, sf)
    root = _bundle_root(spark, "popularity")
    ST.save_model_tables(root, {"popularity": P.bayesian_popularity(r), "movies": m})
    return ST.load_model_tables(spark, root)["popularity"]


@query("pipeline_recommend", code="R14")
def q_pipeline_recommend(spark, sf):
    train, _ = V.split_user(S.interactions(spark, sf))
    cfg = ST.PipelineConfig(n_svd_components=32)
    bundle = ST.fit_pipeline(train, S.movies(spark, sf), S.tags(spark, sf), _bundle_root(spark, "pipeline"), cfg)
    return ST.pipeline_recommend(bundle, k=10, config=cfg)


def _split(spark, sf):
    return V.split_user(S.interactions(spark, sf))


def _eval_pop_and_uu(spark, sf, threshold):
    train, test = _split(spark, sf)
    m = S.movies(spark, sf)
    users = V.eval_sample(V.ground_truth(test, threshold), None)
    pop = P.popularity_for_users(users, train, k=20)
    uu = N.user_user_cf(train, k=20).join(users, "userId", "left_semi")
    return (V.evaluate_model(pop, test, train, m, "popularity", threshold)
            .unionByName(V.evaluate_model(uu, test, train, m, "user_user_cf", threshold)))


SPLIT_35 = SPLIT_SQL.replace("rating >= 4.0E0", "rating >= 3.5E0")
UU_TRAIN = UU_CTES.replace("interactions", "train")
POP_RECS = """
, recs_pop AS (
  SELECT u.userId, t.rank, t.movieId FROM eusers u CROSS JOIN (
    SELECT movieId, row_number() OVER (ORDER BY score DESC, movieId) AS rank
    FROM (SELECT * FROM train_pop ORDER BY score DESC, movieId LIMIT 20)) t)"""
UU_RECS = UU_TRAIN + f"""
, recs_uu AS ({topk_sql('pred', 'userId', 'movieId', 20, score='score')})"""


def _metrics_block(model: str, recs: str) -> str:
    """Metric CTEs for one model, namespaced by ``model``; ends with CTE ``m_{model}``."""
    body = metrics_sql(model)
    sel = body.index("\nSELECT '")
    ctes = body[:sel].replace("recs", recs)
    final = body[sel:]
    names = ["ks", "hits", "cum", "per", "nrel", "base", "rk", "top10", "gv", "rl", "pairs", "shared", "ild"]
    import re
    for n in names:
        ctes = re.sub(rf"\b{n}\b", f"{n}_{model}", ctes)
        final = re.sub(rf"\b{n}\b", f"{n}_{model}", final)
    return ctes + f"\n, m_{model} AS ({final})"


EVAL2_SQL = (SPLIT_35 + POP_RECS + UU_RECS + _metrics_block("popularity", "recs_pop")
             + _metrics_block("user_user_cf", "recs_uu")
             + "\n, allm AS (SELECT * FROM m_popularity UNION ALL SELECT * FROM m_user_user_cf)")

REPORT_COLS = [f"{m}@{k}" for m in ("map", "ndcg", "precision", "recall") for k in (5, 10, 20)] + [
    "coverage@10", "intra_list_diversity@10", "novelty@10"]


@query("benchmark_report", code="S13/E10", floats=tuple(f'"{c}"' for c in REPORT_COLS), sql=EVAL2_SQL + """
SELECT model, """ + ",\n  ".join(
    f"max(CASE WHEN metric || '@' || CAST(k AS VARCHAR) = '{c}' THEN value END) AS \"{c}\"" for c in REPORT_COLS)
    + "\nFROM allm GROUP BY model")
def q_benchmark_report(spark, sf):
    long = _eval_pop_and_uu(spark, sf, REL_35)
    return V.report_table(long, REPORT_COLS)


@query("personalization_lift", code="E12", floats=("lift_pct",), sql=EVAL2_SQL + """
SELECT m.model, m.metric, (m.value - b.value) / greatest(1e-5, b.value) * 100 AS lift_pct
FROM allm m JOIN allm b ON b.model = 'popularity' AND b.metric = m.metric AND b.k = m.k
WHERE m.model <> 'popularity' AND m.k = 10 AND m.metric IN ('precision', 'recall')""")
def q_personalization_lift(spark, sf):
    return V.personalization_lift(_eval_pop_and_uu(spark, sf, REL_35), "popularity", 10)


@query("benchmark_models", code="E11")
def q_benchmark_models(spark, sf):
    """Popularity vs SVD vs hybrid (SVD + content profile) on one temporal split."""
    train, test = _split(spark, sf)
    m, t = S.movies(spark, sf), S.tags(spark, sf)
    users = written(V.eval_sample(V.ground_truth(test, REL_35), None), "benchmark-users")
    asked = train.join(users, "userId", "left_semi")

    def latent():
        model = L.svd_fit(train, k=32)
        found = L.svd_candidates(train, model, 80, users)
        return (L.svd_recommend(train, model, k=20, users=users, found=found),
                L.svd_recommend(train, model, k=80, users=users, found=found))

    def content():
        return N.recommend_from_profile(asked, m, t, k=80).withColumnRenamed("sim", "score")

    def values(name, recs):
        return written(V.evaluate_model(recs(), test, train, m, name, REL_35), f"metrics-{name}")
    (svd, collab), profile, pop = together(
        spark, latent, content, lambda: values("popularity", lambda: P.popularity_for_users(users, train, k=20)))
    lat, hyb = together(spark, lambda: values("svd", lambda: svd),
                        lambda: values("hybrid", lambda: H.hybrid_recommend(collab, profile, asked, m, k=20)))
    return pop.unionByName(lat).unionByName(hyb)


@query("component_ablation", code="E13")
def q_component_ablation(spark, sf):
    """Genre-only and tag-only content profiles vs the full content stack vs SVD
    vs the full hybrid."""
    from cinelake.operators import textfeat as X
    from cinelake.operators.prep import frequent_tags
    train, test = _split(spark, sf)
    m, t = S.movies(spark, sf), S.tags(spark, sf)

    def tag_space():
        counts = X.tag_term_counts(frequent_tags(t, 2))
        return X.tfidf_from_counts(counts, m.agg(F.count(F.lit(1)).alias("n_docs")))

    def values(name, recs):
        return written(V.evaluate_model(recs, test, train, m, name, REL_35), f"metrics-{name}")

    def profile(name, item_vecs):
        return values(name, N.recommend_from_profile(train, m, t, k=20, item_vecs=item_vecs).withColumnRenamed("sim", "score"))

    def stack():
        iv = written(N.content_vectors(m, t), "content-stack")
        found = N.profile_candidates(train, m, t, 80, iv)
        top = lambda k: N.recommend_from_profile(train, m, t, k=k, item_vecs=iv, found=found).withColumnRenamed("sim", "score")
        return values("content_stack", top(20)), top(80)

    def latent():
        return L.svd_recommend(train, L.svd_fit(train, k=32), k=80)
    genre, tag, (whole, content), collab = together(
        spark, lambda: profile("genre_only", X.genre_multihot(m)), lambda: profile("tag_only", tag_space()), stack, latent)
    svd, hybrid = together(spark, lambda: values("svd", collab.where("rank <= 20")),
                           lambda: values("hybrid", H.hybrid_recommend(collab, content, train, m, k=20)))
    return genre.unionByName(tag).unionByName(whole).unionByName(svd).unionByName(hybrid)


@query("latest_per_pair", code="W7", floats=("rating",), sql="""
SELECT userId, movieId, rating FROM interactions""")
def q_latest_per_pair(spark, sf):
    """The canonical ratings view *is* W7: last line per (user, movie) wins."""
    return S.interactions(spark, sf).select("userId", "movieId", "rating")


@query("join_movies_tags", code="J1", sql="""
, tagg AS (SELECT movieId, string_agg(trim(lower(tag)), ' ' ORDER BY userId, ts, trim(lower(tag))) AS combined_tags
           FROM tags WHERE tag IS NOT NULL GROUP BY movieId)
SELECT m.movieId, m.title, coalesce(t.combined_tags, '') AS combined_tags
FROM movies m LEFT JOIN tagg t ON t.movieId = m.movieId""")
def q_join_movies_tags(spark, sf):
    from cinelake.operators.prep import combine_tags, frequent_tags
    tg = combine_tags(frequent_tags(S.tags(spark, sf), 1))
    return (S.movies(spark, sf).select("movieId", "title").join(tg, "movieId", "left")
            .fillna("", subset=["combined_tags"]))


@query("save_model_tables", code="S9", sql="""
SELECT 'movies' AS table_name, count(*) AS n_rows FROM movies
UNION ALL SELECT 'popularity', count(*) FROM pop""")
def q_save_model_tables(spark, sf):
    """Write a bundle (tables first, manifest last) to the shared checkpoint
    folder; report every stored table's row count as read back from storage."""
    r, m = S.interactions(spark, sf), S.movies(spark, sf)
    root = _bundle_root(spark, "save")
    folder = ST.save_model_tables(root, {"popularity": P.bayesian_popularity(r), "movies": m})
    parts = [spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows") for name in ("movies", "popularity")]
    return parts[0].unionByName(parts[1])


@query("load_model_tables", code="S10", sql="SELECT movieId, title, genres FROM movies")
def q_load_model_tables(spark, sf):
    """Reload a stored bundle through the manifest check; the catalog table
    comes back unchanged."""
    root = _bundle_root(spark, "load")
    ST.save_model_tables(root, {"movies": S.movies(spark, sf)})
    return ST.load_model_tables(spark, root)["movies"].select("movieId", "title", "genres")


@query("write_report", code="S13", floats=tuple(f'"{c}"' for c in REPORT_COLS), sql=EVAL2_SQL + """
SELECT model, """ + ",\n  ".join(
    f"max(CASE WHEN metric || '@' || CAST(k AS VARCHAR) = '{c}' THEN value END) AS \"{c}\"" for c in REPORT_COLS)
    + "\nFROM allm GROUP BY model")
def q_write_report(spark, sf):
    """The benchmark table written as one CSV with a header under the shared
    checkpoint folder, read back with a fixed schema."""
    from pyspark.sql import types as T
    report = V.report_table(_eval_pop_and_uu(spark, sf, REL_35), REPORT_COLS)
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/reports/benchmark-{uuid.uuid4().hex[:8]}"
    V.write_report(report, path)
    schema = T.StructType([T.StructField("model", T.StringType())]
                          + [T.StructField(c, T.DoubleType()) for c in REPORT_COLS])
    return spark.read.schema(schema).option("header", True).csv(path)


@query("fit_pipeline", code="R14")
def q_fit_pipeline(spark, sf):
    """Fit every model table from ratings, movies and tags into one bundle;
    report the stored tables and their row counts."""
    cfg = ST.PipelineConfig(n_svd_components=32)
    bundle = ST.fit_pipeline(S.interactions(spark, sf), S.movies(spark, sf), S.tags(spark, sf),
                             _bundle_root(spark, "fit"), cfg)
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in sorted(bundle.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
