"""Registered queries: title / genre / tag text columns, n-grams, TF-IDF,
vocabulary cap and the scalar helpers (P2, P4, P5, P8, X2, X3, X4, F2, F6, O7)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from cinelake.functions.ranking import order_cols, top_k_global
from cinelake.functions.text import clean_title, genre_tokens
from cinelake.operators import prep as R
from cinelake.operators import textfeat as X
from cinelake.operators.popularity import bayesian_popularity
from cinelake.plans.q_neighbors import TITLE_DOCS, tfidf_sql
from cinelake.plans.q_prep import CLEAN_SQL, GENRE_EXPLODE_SQL, TAGS_CLEAN_SQL
from cinelake.plans.registry import query
from cinelake.sources import tables as S

GENRE_TOKENS_SQL = "replace(replace(genres, '|', ' '), '(no genres listed)', '')"


@query("clean_title", code="P2", sql=f"SELECT movieId, {CLEAN_SQL} AS clean_title FROM movies")
def q_clean_title(spark, sf):
    return S.movies(spark, sf).select("movieId", clean_title(F.col("title")).alias("clean_title"))


@query("genre_tokens", code="P4", sql=f"SELECT movieId, {GENRE_TOKENS_SQL} AS genre_tokens FROM movies")
def q_genre_tokens(spark, sf):
    return S.movies(spark, sf).select("movieId", genre_tokens(F.col("genres")).alias("genre_tokens"))


@query("content_soup", code="P5", sql=TAGS_CLEAN_SQL + f"""
SELECT m.movieId, trim(concat_ws(' ', {CLEAN_SQL}, {GENRE_TOKENS_SQL}, coalesce(t.combined_tags, ''))) AS content_soup
FROM movies m LEFT JOIN tagg t ON t.movieId = m.movieId""")
def q_content_soup(spark, sf):
    return R.content_metadata(S.movies(spark, sf), S.tags(spark, sf)).select("movieId", "content_soup")


@query("combine_tags", code="P8", sql="""
SELECT movieId, string_agg(trim(lower(tag)), ' ' ORDER BY userId, ts, trim(lower(tag))) AS combined_tags
FROM tags WHERE tag IS NOT NULL GROUP BY movieId""")
def q_combine_tags(spark, sf):
    """Every normalised tag of a movie, duplicates kept (no frequency filter)."""
    return R.combine_tags(R.normalise_tags(S.tags(spark, sf)))


TAG_TEXT = "SELECT movieId AS id, combined_tags AS text FROM tagg"


@query("ngrams", code="X3", sql=TAGS_CLEAN_SQL + tfidf_sql("tagn", TAG_TEXT, 1, None) + """
SELECT id AS movieId, term, tf FROM tagn_tf""")
def q_ngrams(spark, sf):
    """1-2-gram counts of each movie's combined tags; bigrams are formed after
    stop-word removal and run across tag borders.  Counted from the tag rows
    (a distributed lag supplies the cross-border bigram), never from one
    collected document per movie."""
    return X.tag_term_counts(R.frequent_tags(S.tags(spark, sf), 2)).withColumnRenamed("id", "movieId")


@query("tfidf", code="X2", floats=("w",), sql=tfidf_sql("title", TITLE_DOCS, 1, None) + """
SELECT id AS movieId, term, w FROM title_vec""")
def q_tfidf(spark, sf):
    """Title TF-IDF (1-2-grams, stop words, sublinear tf, smooth idf, L2 rows)."""
    m = S.movies(spark, sf).select("movieId", clean_title(F.col("title")).alias("clean_title"))
    return X.tfidf(m, "movieId", "clean_title", 1).withColumnRenamed("id", "movieId")


@query("vocab_cap", code="X4", sql=tfidf_sql("doc", "SELECT doc_id AS id, text FROM documents", 2, 2000) + """
SELECT term, df, ctf FROM doc_vocab""")
def q_vocab_cap(spark, sf):
    """The 2,000 terms with the largest corpus count (ties by term) among terms
    in >= 2 documents, over every document's whole text."""
    d = S.base(spark, sf, "documents").select("doc_id", "text")
    return X.vocabulary(X.term_counts(d, "doc_id", "text"), min_df=2, max_features=2000)


@query("cyclical_month", code="F2", floats=("month_sin", "month_cos"), sql="""
SELECT userId, movieId, CAST(month(ts) AS BIGINT) AS month,
  sin(2 * pi() * month(ts) / 12.0E0) AS month_sin, cos(2 * pi() * month(ts) / 12.0E0) AS month_cos
FROM interactions""")
def q_cyclical_month(spark, sf):
    mo = F.month("ts")
    ang = F.lit(2 * math.pi) * mo / F.lit(12.0)
    return S.interactions(spark, sf).select("userId", "movieId", mo.alias("month"),
                                            F.sin(ang).alias("month_sin"), F.cos(ang).alias("month_cos"))


@query("cosine", code="F6", floats=("cosine",), sql="""
, gvec AS (SELECT DISTINCT movieId AS id, g AS term FROM (
    SELECT movieId, unnest(string_split(coalesce(genres, '(no genres listed)'), '|')) AS g FROM movies))
, seed AS (SELECT term FROM gvec WHERE id = (SELECT movieId FROM pop ORDER BY score DESC, movieId LIMIT 1))
, dot AS (SELECT v.id, count(*) AS d FROM gvec v JOIN seed s ON s.term = v.term GROUP BY v.id)
, nrm AS (SELECT id, count(*) AS n FROM gvec GROUP BY id)
SELECT n.id AS movieId, coalesce(d.d, 0) / sqrt(n.n * (SELECT count(*) FROM seed)) AS cosine
FROM nrm n LEFT JOIN dot d ON d.id = n.id""")
def q_cosine(spark, sf):
    """Genre-vector cosine of every movie to the most popular movie, in long
    form: the dot product is a join on term against the seed's terms (one
    movie's genres: a proven small broadcast), norms are per-id sums."""
    vec = X.genre_multihot(S.movies(spark, sf))
    top = top_k_global(bayesian_popularity(S.interactions(spark, sf)), 1, order_cols()).select("movieId")
    seed = vec.join(top.withColumnRenamed("movieId", "id"), "id", "left_semi").select(
        "term", F.col("w").alias("ws"))
    dot = vec.join(F.broadcast(seed), "term").groupBy("id").agg(F.sum(F.col("w") * F.col("ws")).alias("d"))
    nrm = vec.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"))
    ns = seed.agg(F.sqrt(F.sum(F.col("ws") * F.col("ws"))).alias("ns"))
    j = nrm.join(dot, "id", "left").crossJoin(F.broadcast(ns))     # one-row frame
    return j.select(F.col("id").alias("movieId"),
                    (F.coalesce(F.col("d"), F.lit(0.0)) / (F.col("n") * F.col("ns"))).alias("cosine"))


@query("distinct_genres", code="O7", sql=f"SELECT DISTINCT genre FROM ({GENRE_EXPLODE_SQL})")
def q_distinct_genres(spark, sf):
    return R.explode_genres(S.movies(spark, sf)).select("genre").distinct()
