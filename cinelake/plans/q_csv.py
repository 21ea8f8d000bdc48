"""Registered queries: the tables written as CSV files in the published dialect
(titles with quotes, commas and newlines, tags with quotes, and some records
that do not parse) into the shared folder and read back by the loaders."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cinelake.operators.prep import enrich_movies, epoch_seconds, kcore_filter, load_tags
from cinelake.plans.q_prep import CLEAN_SQL, YEAR_SQL
from cinelake.plans.registry import query
from cinelake.session import ensure_checkpoint_dir
from cinelake.sources import tables as S

CSV_TITLE = """CASE WHEN movieId % 5 = 0 THEN concat('say "', title, '", now') WHEN movieId % 5 = 1 THEN concat('one, "two"', chr(10), title)
  WHEN movieId % 5 = 2 THEN concat('""Great"" ', title) ELSE title END"""
CSV_TAG = """CASE WHEN movieId % 3 = 0 THEN '"' || tag || '", or so' WHEN movieId % 3 = 1 THEN tag || chr(10) || 'more' ELSE tag END"""
CSV_VIEWS = f"""
, cmovies AS (SELECT movieId, {CSV_TITLE} AS title, genres FROM movies)
, ctags AS (SELECT userId, movieId, {CSV_TAG} AS tag, ts FROM tags)"""


def _written_csv(spark, sf, *names):
    """A folder with the named tables as CSV."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    for name in names:
        if name == "movies":
            good = S.movies(spark, sf).select("movieId", F.expr(CSV_TITLE).alias("title"), "genres")
            bad = good.where("movieId % 97 = 3").select(F.concat(F.lit("m"), "movieId").alias("movieId"), F.lit("no movie").alias("title"), F.lit("x").alias("genres"))
        elif name == "tags":
            good = S.tags(spark, sf).select("userId", "movieId", F.expr(CSV_TAG).alias("tag"), epoch_seconds("ts").alias("timestamp"))
            bad = good.where("movieId % 97 = 3").select("userId", "movieId", F.lit("late").alias("tag"), F.lit("yesterday").alias("timestamp"))
        else:
            good = S.interactions(spark, sf).select("userId", "movieId", "rating", epoch_seconds("ts").alias("timestamp"))
            bad = good.where("movieId % 97 = 3").select("userId", "movieId", F.lit("four").alias("rating"), F.lit(0).alias("timestamp"))
        S.write_csv(good, root, name)
        S.write_csv(bad, root, name, mode="append")
    return root


@query("csv_movies", code="S1 (CSV)", sql=CSV_VIEWS + f"""
SELECT movieId, title, genres, {YEAR_SQL} AS year, {CLEAN_SQL} AS clean_title FROM cmovies""")
def q_csv_movies(spark, sf):
    """Movies written and read back as CSV: titles with doubled quotes, commas
    and newlines; records without a numeric id are left out."""
    return enrich_movies(S.load_movies_csv(spark, _written_csv(spark, sf, "movies")))


@query("csv_ratings", code="S2/P9 (CSV)", floats=("rating",), sql="""
, u AS (SELECT userId FROM interactions GROUP BY 1 HAVING count(*) >= 30)
, m AS (SELECT movieId FROM interactions GROUP BY 1 HAVING count(*) >= 25)
SELECT userId, movieId, rating, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp FROM interactions
WHERE userId IN (SELECT userId FROM u) AND movieId IN (SELECT movieId FROM m)""")
def q_csv_ratings(spark, sf):
    """Ratings read from CSV with activity filters over the loaded rows."""
    r = S.load_ratings_csv(spark, _written_csv(spark, sf, "ratings"))
    return kcore_filter(r, 30, 25).select("userId", "movieId", "rating", "timestamp")


@query("csv_tags", code="S3 (CSV)", sql=CSV_VIEWS + """
, c AS (SELECT userId, movieId, ts, trim(lower(tag)) AS tag_clean FROM ctags WHERE tag IS NOT NULL)
, f AS (SELECT tag_clean FROM c GROUP BY 1 HAVING count(*) >= 2)
SELECT movieId, string_agg(tag_clean, ' ' ORDER BY userId, ts, tag_clean) AS combined_tags
FROM c WHERE tag_clean IN (SELECT tag_clean FROM f) GROUP BY movieId""")
def q_csv_tags(spark, sf):
    """Tags read from CSV (quotes, commas and newlines inside), then normalised,
    filtered by frequency and combined as for every other input."""
    return load_tags(S.load_tags_csv(spark, _written_csv(spark, sf, "tags")), min_tag_freq=2)


@query("csv_quarantine", code="S1-S3 (CSV)", sql="""
SELECT 'movies' AS table_name, concat('m', movieId, ',no movie,x') AS record FROM movies WHERE movieId % 97 = 3
UNION ALL SELECT 'tags', concat(userId, ',', movieId, ',late,yesterday') FROM tags WHERE movieId % 97 = 3
UNION ALL SELECT 'ratings', concat(userId, ',', movieId, ',four,0') FROM interactions WHERE movieId % 97 = 3""")
def q_csv_quarantine(spark, sf):
    """The malformed records of the three files, as they stand in them."""
    root = _written_csv(spark, sf, "movies", "tags", "ratings")
    parts = [S.quarantined_csv(spark, root, t) for t in ("movies", "tags", "ratings")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
