"""Registered queries: TF-IDF features and neighbourhood recommenders."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinelake.functions.stopwords import sql_list
from cinelake.operators import neighbors as N
from cinelake.operators import textfeat as X
from cinelake.plans.q_prep import CLEAN_SQL, TAGS_CLEAN_SQL
from cinelake.plans.registry import query
from cinelake.sources import tables as S

STOP = sql_list()


def tfidf_sql(name: str, docs: str, min_df: int, max_features: int | None, weight: str = "1.0E0",
              prefix: str = "") -> str:
    """CTEs ``{name}_vec(id, term, w)``: TF-IDF of ``docs(id, text)`` (unnormalised
    stack weight applied after the L2 normalisation)."""
    cap = f"ORDER BY ctf DESC, term LIMIT {max_features}" if max_features else ""
    return f"""
, {name}_docs AS ({docs})
, {name}_tok AS (
  SELECT id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
                         lambda x: NOT list_contains({STOP}, x)) AS t FROM {name}_docs)
, {name}_terms AS (
  SELECT id, unnest(list_concat(t, CASE WHEN len(t) >= 2
           THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) ELSE [] END)) AS term
  FROM {name}_tok)
, {name}_tf AS (SELECT id, term, count(*) AS tf FROM {name}_terms GROUP BY id, term)
, {name}_vocab AS (SELECT term, count(*) AS df, sum(tf) AS ctf FROM {name}_tf GROUP BY term
                   HAVING count(*) >= {min_df} {cap})
, {name}_w0 AS (
  SELECT f.id, f.term, (1 + ln(f.tf)) * (ln((1 + n.n) / (1 + v.df)) + 1) AS w
  FROM {name}_tf f JOIN {name}_vocab v ON v.term = f.term, (SELECT count(*) AS n FROM {name}_docs) n)
, {name}_vec AS (
  SELECT id, '{prefix}' || term AS term, {weight} * w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w
  FROM {name}_w0)"""


TAG_DOCS = ("SELECT m.movieId AS id, coalesce(t.combined_tags, '') AS text FROM movies m "
            "LEFT JOIN tagg t ON t.movieId = m.movieId")
TITLE_DOCS = f"SELECT movieId AS id, {CLEAN_SQL} AS text FROM movies"
GENRE_VEC = """
, genre_vec AS (
  SELECT DISTINCT movieId AS id, 'g:' || g AS term, 1.0E0 AS w FROM (
    SELECT movieId, unnest(string_split(coalesce(genres, '(no genres listed)'), '|')) AS g FROM movies))"""
CONTENT_VEC = (TAGS_CLEAN_SQL + GENRE_VEC
               + tfidf_sql("tagc", TAG_DOCS, 1, None, "1.5E0", "t:")
               + tfidf_sql("title", TITLE_DOCS, 1, None, "0.8E0", "n:") + """
, content_raw AS (SELECT * FROM genre_vec UNION ALL SELECT * FROM tagc_vec UNION ALL SELECT * FROM title_vec)
, content_vec AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM content_raw)""")


def topk_sql(pairs: str, seed: str, item: str, k: int, score: str = "sim", where: str = "") -> str:
    return f"""
SELECT {seed}, rank, {item}, {score} FROM (
  SELECT *, row_number() OVER (PARTITION BY {seed} ORDER BY {score} DESC, {item}) AS rank FROM {pairs} {where})
WHERE rank <= {k}"""


@query("tfidf_documents", code="X2/X3/X4", floats=("w",), sql=tfidf_sql(
    "doc", "SELECT doc_id AS id, text FROM documents", 2, None) + "\nSELECT id AS doc_id, term, w FROM doc_vec")
def q_tfidf_documents(spark, sf):
    d = S.base(spark, sf, "documents").select("doc_id", "text")
    return X.tfidf(d, "doc_id", "text", min_df=2).withColumnRenamed("id", "doc_id")


@query("genre_multihot", code="X1", sql="""
SELECT DISTINCT movieId, g AS genre FROM (
  SELECT movieId, unnest(string_split(coalesce(genres, '(no genres listed)'), '|')) AS g FROM movies)""")
def q_genre_multihot(spark, sf):
    return X.genre_multihot(S.movies(spark, sf)).select(F.col("id").alias("movieId"), F.col("term").alias("genre"))


@query("feature_stack", code="X5", floats=("w",), sql=CONTENT_VEC + "\nSELECT id AS movieId, term, w FROM content_raw")
def q_feature_stack(spark, sf):
    v = N.content_vectors(S.movies(spark, sf), S.tags(spark, sf))
    return v.select(F.col("id").alias("movieId"), "term", "w")


@query("similar_by_genre", code="R1", floats=("sim",), sql="""
, mg AS (SELECT movieId, list_distinct(string_split(coalesce(genres, '(no genres listed)'), '|')) AS g
         FROM movies)
, gpairs AS (SELECT a.movieId AS seed, b.movieId AS movieId,
                    round(len(list_intersect(a.g, b.g)) / sqrt(len(a.g) * len(b.g)), 12) AS sim
             FROM mg a JOIN mg b ON a.movieId <> b.movieId)""" + topk_sql("gpairs", "seed", "movieId", 10))
def q_similar_by_genre(spark, sf):
    return N.similar_by_genre(S.movies(spark, sf), k=10)


@query("similar_by_tags", code="R2", floats=("sim",), sql=TAGS_CLEAN_SQL + tfidf_sql(
    "tag", TAG_DOCS, 2, None) + """
, tpairs AS (SELECT a.id AS seed, b.id AS movieId, round(sum(a.w * b.w), 12) AS sim
             FROM tag_vec a JOIN tag_vec b ON a.term = b.term AND a.id <> b.id GROUP BY a.id, b.id)"""
    + topk_sql("tpairs", "seed", "movieId", 10, where="WHERE sim > 0"))
def q_similar_by_tags(spark, sf):
    return N.similar_by_tags(S.movies(spark, sf), S.tags(spark, sf), k=10)


@query("similar_by_content", code="R3", floats=("sim",), sql=CONTENT_VEC + """
, cpos AS (SELECT a.id AS seed, b.id AS movieId, sum(a.w * b.w) AS sim
           FROM content_vec a JOIN content_vec b ON a.term = b.term AND a.id <> b.id GROUP BY a.id, b.id)
, cpairs AS (SELECT a.movieId AS seed, b.movieId AS movieId, round(greatest(coalesce(p.sim, 0), 0), 12) AS sim
             FROM movies a JOIN movies b ON a.movieId <> b.movieId
             LEFT JOIN cpos p ON p.seed = a.movieId AND p.movieId = b.movieId)"""
    + topk_sql("cpairs", "seed", "movieId", 10))
def q_similar_by_content(spark, sf):
    return N.similar_by_content(S.movies(spark, sf), S.tags(spark, sf), k=10)


PROFILE_CTES = CONTENT_VEC + """
, prof_raw AS (SELECT i.userId AS id, v.term, sum((i.rating - 2.5E0) * v.w) AS w
               FROM interactions i JOIN content_raw v ON v.id = i.movieId
               WHERE i.rating >= 3.0E0 GROUP BY i.userId, v.term)
, prof AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM prof_raw WHERE w <> 0)
, ppos AS (SELECT p.id AS userId, c.id AS movieId, sum(p.w * c.w) AS sim
           FROM prof p JOIN content_vec c ON c.term = p.term GROUP BY p.id, c.id)
, ppairs AS (
  SELECT u.id AS userId, m.movieId, round(greatest(coalesce(p.sim, 0), 0), 12) AS sim
  FROM (SELECT DISTINCT id FROM prof) u CROSS JOIN movies m
  LEFT JOIN ppos p ON p.userId = u.id AND p.movieId = m.movieId
  WHERE NOT EXISTS (SELECT 1 FROM interactions i WHERE i.userId = u.id AND i.movieId = m.movieId))"""


@query("recommend_from_profile", code="R4", floats=("sim",), sql=PROFILE_CTES + topk_sql("ppairs", "userId", "movieId", 10))
def q_recommend_from_profile(spark, sf):
    return N.recommend_from_profile(S.interactions(spark, sf), S.movies(spark, sf), S.tags(spark, sf), k=10)


ITEM_VEC = """
, ivec AS (SELECT movieId AS id, userId AS term, rating / sqrt(sum(rating * rating) OVER (PARTITION BY movieId)) AS w
           FROM interactions)"""


@query("item_item_cf", code="R9/J9", floats=("sim",), sql=ITEM_VEC + """
, ipos AS (SELECT a.id AS seed, b.id AS movieId, sum(a.w * b.w) AS sim
           FROM ivec a JOIN ivec b ON a.term = b.term AND a.id <> b.id GROUP BY a.id, b.id)
, rated AS (SELECT DISTINCT movieId FROM interactions)
, ipairs AS (SELECT a.movieId AS seed, b.movieId AS movieId, round(greatest(coalesce(p.sim, 0), 0), 12) AS sim
             FROM rated a JOIN rated b ON a.movieId <> b.movieId
             LEFT JOIN ipos p ON p.seed = a.movieId AND p.movieId = b.movieId)"""
    + topk_sql("ipairs", "seed", "movieId", 10))
def q_item_item_cf(spark, sf):
    return N.item_item_cf(S.interactions(spark, sf), k=10)


UU_CTES = """
, uvec AS (SELECT userId AS id, movieId AS term, rating / sqrt(sum(rating * rating) OVER (PARTITION BY userId)) AS w
           FROM interactions)
, upos AS (SELECT a.id AS userId, b.id AS nbr, round(sum(a.w * b.w), 12) AS sim
           FROM uvec a JOIN uvec b ON a.term = b.term AND a.id <> b.id GROUP BY a.id, b.id)
, nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY sim DESC, nbr) AS r FROM upos
                        WHERE sim > 0) WHERE r <= 30)
, pred AS (SELECT nb.userId, i.movieId, round(sum(nb.sim * i.rating) / sum(nb.sim), 12) AS score
           FROM nb JOIN interactions i ON i.userId = nb.nbr
           WHERE NOT EXISTS (SELECT 1 FROM interactions s WHERE s.userId = nb.userId AND s.movieId = i.movieId)
           GROUP BY nb.userId, i.movieId)"""


@query("user_user_cf", code="R9b", floats=("score",), sql=UU_CTES + topk_sql("pred", "userId", "movieId", 10, score="score"))
def q_user_user_cf(spark, sf):
    return N.user_user_cf(S.interactions(spark, sf), k=10, n_neighbors=30)


@query("latent_neighbours", code="R15/F6", floats=("sim",), sql="""
, ev AS (SELECT vec_id AS id, unnest(embedding)::DOUBLE AS w, unnest(range(len(embedding))) AS term
         FROM embeddings)
, evn AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM ev)
, epairs AS (SELECT a.id AS seed, b.id AS neighbour, round(sum(a.w * b.w), 12) AS sim
             FROM evn a JOIN evn b ON a.term = b.term AND a.id <> b.id GROUP BY a.id, b.id)"""
    + topk_sql("epairs", "seed", "neighbour", 5))
def q_latent_neighbours(spark, sf):
    return N.embedding_neighbours(S.base(spark, sf, "embeddings"), k=5)


@query("corating_self_join", code="J9", sql="""
SELECT movieId, rank, other, n_shared FROM (
  SELECT a.movieId, b.movieId AS other, count(*) AS n_shared,
         row_number() OVER (PARTITION BY a.movieId ORDER BY count(*) DESC, b.movieId) AS rank
  FROM interactions a JOIN interactions b ON a.userId = b.userId AND a.movieId <> b.movieId
  GROUP BY a.movieId, b.movieId)""")
def q_corating_self_join(spark, sf):
    """The shared-user pair counts behind every item neighbour query: all pairs
    of movies with a user in common, ranked within each movie. Baskets meet their
    own movies where they lie, the pairs of the self join are never shuffled."""
    from cinelake.operators.cooccur import shared_users
    return shared_users(S.interactions(spark, sf))


@query("neighbour_pruning", code="R2/R3/R9/R9b (work)")
def q_neighbour_pruning(spark, sf):
    """Of the (seed, run of ids) cells that each neighbour query has, how many
    its bounds left to be scored."""
    from cinelake.operators import pruned as P
    r, m, t = S.interactions(spark, sf), S.movies(spark, sf), S.tags(spark, sf)
    out = None
    for name, k, v in (("similar_by_tags", 10, N.tag_vectors(m, t)), ("similar_by_content", 10, N.content_vectors(m, t)),
                       ("item_item_cf", 10, r.select(F.col("movieId").alias("id"), F.col("userId").alias("term"), F.col("rating").alias("w"))),
                       ("user_user_cf", 30, r.select(F.col("userId").alias("id"), F.col("movieId").alias("term"), F.col("rating").alias("w")))):
        one = P.pruned_share(P.candidates(v, v, k)).select(F.lit(name).alias("query"), "cells", "scored", "pruned")
        out = one if out is None else out.unionByName(one)
    return out
