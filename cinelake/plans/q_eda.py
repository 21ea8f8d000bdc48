"""Registered queries: EDA aggregates, audits and derived scalar features."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinelake.functions.quantiles import exact_percentiles
from cinelake.operators import eda as E
from cinelake.operators.prep import epoch_seconds
from cinelake.plans.registry import query
from cinelake.sources import tables as S

EPOCH = "CAST(floor(epoch(ts)) AS BIGINT)"


def _canon(spark, sf):
    return {"ratings": S.interactions(spark, sf), "movies": S.movies(spark, sf),
            "tags": S.tags(spark, sf), "links": S.links(spark, sf)}


@query("table_dims", code="A1", sql="""
SELECT 'ratings' AS table_name, count(*) AS n_rows, CAST(4 AS BIGINT) AS n_cols FROM interactions
UNION ALL SELECT 'movies', count(*), 3 FROM movies
UNION ALL SELECT 'tags', count(*), 4 FROM tags
UNION ALL SELECT 'links', count(*), 3 FROM links""")
def q_table_dims(spark, sf):
    return E.table_dims(_canon(spark, sf))


@query("distinct_entities", code="A2/O7", floats=("coverage_pct",), sql="""
SELECT (SELECT count(DISTINCT userId) FROM interactions) AS n_users,
       (SELECT count(DISTINCT movieId) FROM interactions) AS n_rated_movies,
       (SELECT count(*) FROM movies) AS n_catalog,
       (SELECT count(DISTINCT trim(g)) FROM (SELECT unnest(string_split(genres, '|')) AS g FROM movies)
         WHERE trim(g) <> '' AND trim(g) <> '(no genres listed)') AS n_genres,
       (SELECT count(DISTINCT trim(lower(tag))) FROM tags WHERE tag IS NOT NULL) AS n_tags,
       (SELECT count(DISTINCT rating) FROM interactions) AS n_rating_values,
       (SELECT count(DISTINCT movieId) FROM interactions WHERE movieId IN (SELECT movieId FROM movies)) * 100.0E0
         / (SELECT count(*) FROM movies) AS coverage_pct""")
def q_distinct_entities(spark, sf):
    from cinelake.functions.text import genre_array, normalise_tag
    r, m, t = S.interactions(spark, sf), S.movies(spark, sf), S.tags(spark, sf)
    a = r.agg(F.countDistinct("userId").alias("n_users"), F.countDistinct("movieId").alias("n_rated_movies"),
              F.countDistinct("rating").alias("n_rating_values"))
    mc = m.agg(F.count(F.lit(1)).alias("n_catalog"))
    g = m.select(F.explode(genre_array(F.col("genres"))).alias("g")).agg(F.countDistinct("g").alias("n_genres"))
    tg = t.where(F.col("tag").isNotNull()).agg(F.countDistinct(normalise_tag(F.col("tag"))).alias("n_tags"))
    cov = (r.select("movieId").distinct().join(m.select("movieId"), "movieId", "left_semi")
           .agg(F.count(F.lit(1)).alias("n_cov")))
    j = a.crossJoin(mc).crossJoin(g).crossJoin(tg).crossJoin(cov)   # one-row frames
    return j.select("n_users", "n_rated_movies", "n_catalog", "n_genres", "n_tags", "n_rating_values",
                    (F.col("n_cov") * 100.0 / F.col("n_catalog")).alias("coverage_pct"))


COLUMN_TYPES = [  # canonical columns and their type families
    ("ratings", "interactions", [("userId", "integer"), ("movieId", "integer"), ("rating", "float"), ("ts", "timestamp")]),
    ("movies", "movies", [("movieId", "integer"), ("title", "string"), ("genres", "string")]),
    ("tags", "tags", [("userId", "integer"), ("movieId", "integer"), ("tag", "string"), ("ts", "timestamp")]),
    ("links", "links", [("movieId", "integer"), ("imdbId", "integer"), ("tmdbId", "float")])]


@query("column_types", code="A3", sql="\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS data_type, count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct FROM {v}"
    for t, v, cols in COLUMN_TYPES for c, k in cols))
def q_column_types(spark, sf):
    """Type family, non-null values and distinct values of every canonical column."""
    return E.column_types(_canon(spark, sf))


@query("null_audit", code="A4", sql="""
SELECT 'ratings' AS table_name, 'userId' AS column_name, count_if(userId IS NULL) AS n_null FROM interactions
UNION ALL SELECT 'ratings', 'movieId', count_if(movieId IS NULL) FROM interactions
UNION ALL SELECT 'ratings', 'rating', count_if(rating IS NULL) FROM interactions
UNION ALL SELECT 'ratings', 'ts', count_if(ts IS NULL) FROM interactions
UNION ALL SELECT 'movies', 'movieId', count_if(movieId IS NULL) FROM movies
UNION ALL SELECT 'movies', 'title', count_if(title IS NULL) FROM movies
UNION ALL SELECT 'movies', 'genres', count_if(genres IS NULL) FROM movies
UNION ALL SELECT 'tags', 'userId', count_if(userId IS NULL) FROM tags
UNION ALL SELECT 'tags', 'movieId', count_if(movieId IS NULL) FROM tags
UNION ALL SELECT 'tags', 'tag', count_if(tag IS NULL) FROM tags
UNION ALL SELECT 'tags', 'ts', count_if(ts IS NULL) FROM tags
UNION ALL SELECT 'links', 'movieId', count_if(movieId IS NULL) FROM links
UNION ALL SELECT 'links', 'imdbId', count_if(imdbId IS NULL) FROM links
UNION ALL SELECT 'links', 'tmdbId', count_if(tmdbId IS NULL) FROM links""")
def q_null_audit(spark, sf):
    return E.null_audit(_canon(spark, sf))


RAW_PAIRS = """(SELECT o.o_custkey AS userId, l.l_partkey AS movieId FROM lineitem l
                JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


@query("duplicate_audit", code="A5", sql=f"""
SELECT 'rating_events_same_pair' AS check_name, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_duplicates FROM (
  SELECT count(*) AS c FROM {RAW_PAIRS} GROUP BY userId, movieId HAVING count(*) > 1)
UNION ALL SELECT 'movies_same_movieId', CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (
  SELECT count(*) AS c FROM movies GROUP BY movieId HAVING count(*) > 1)
UNION ALL SELECT 'tags_identical_rows', CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (
  SELECT count(*) AS c FROM tags GROUP BY userId, movieId, tag, ts HAVING count(*) > 1)""")
def q_duplicate_audit(spark, sf):
    li = S.base(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    o = S.base(spark, sf, "orders").select("o_orderkey", "o_custkey")
    raw = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_custkey").alias("userId"),
                                                            F.col("l_partkey").alias("movieId"))

    def dups(df, keys, name):
        c = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        return c.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("bigint").alias("n_duplicates")).select(
            F.lit(name).alias("check_name"), "n_duplicates")
    return (dups(raw, ["userId", "movieId"], "rating_events_same_pair")
            .unionByName(dups(S.movies(spark, sf), ["movieId"], "movies_same_movieId"))
            .unionByName(dups(S.tags(spark, sf), ["userId", "movieId", "tag", "ts"], "tags_identical_rows")))


@query("rating_summary", code="A6",
       floats=("min_rating", "max_rating", "mean_rating", "median_rating", "std_rating"), sql="""
SELECT min(rating) AS min_rating, max(rating) AS max_rating, avg(rating) AS mean_rating,
  quantile_cont(rating, 0.5) AS median_rating, stddev_samp(rating) AS std_rating, count(*) AS n
FROM interactions""")
def q_rating_summary(spark, sf):
    return E.rating_summary(S.interactions(spark, sf))


@query("time_coverage", code="A7", floats=("span_years",), sql=f"""
SELECT min({EPOCH}) AS min_ts, max({EPOCH}) AS max_ts,
  datediff('day', min(ts), max(ts)) / 365.25E0 AS span_years FROM interactions""")
def q_time_coverage(spark, sf):
    r = S.interactions(spark, sf)
    e = epoch_seconds("ts")
    return r.agg(F.min(e).alias("min_ts"), F.max(e).alias("max_ts"),
                 (F.datediff(F.max("ts"), F.min("ts")) / 365.25).alias("span_years"))


@query("rating_histogram", code="A8", floats=("rating", "pct", "cum_pct"), sql="""
SELECT rating, n, n * 100.0E0 / sum(n) OVER () AS pct,
  sum(n) OVER (ORDER BY rating ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0E0 / sum(n) OVER () AS cum_pct
FROM (SELECT rating, count(*) AS n FROM interactions GROUP BY rating)""")
def q_rating_histogram(spark, sf):
    return E.rating_histogram(S.interactions(spark, sf))


DIST_SQL = """
SELECT min(n) AS min_n, quantile_cont(n, 0.5) AS median_n, avg(n) AS mean_n, quantile_cont(n, 0.9) AS q90_n,
  max(n) AS max_n FROM (SELECT {k}, count(*) AS n FROM interactions GROUP BY {k})"""


@query("movie_count_dist", code="A9", floats=("median_n", "mean_n", "q90_n"), sql=DIST_SQL.format(k="movieId"))
def q_movie_count_dist(spark, sf):
    return E.count_distribution(S.interactions(spark, sf), "movieId")


@query("user_count_dist", code="A10", floats=("median_n", "mean_n", "q90_n"), sql=DIST_SQL.format(k="userId"))
def q_user_count_dist(spark, sf):
    return E.count_distribution(S.interactions(spark, sf), "userId")


@query("longtail_thresholds", code="A11", floats=("pct_movies_below", "pct_users_below"), sql="""
SELECT t.threshold,
  (SELECT avg(CASE WHEN coalesce(c.n, 0) < t.threshold THEN 1.0E0 ELSE 0.0E0 END) * 100
   FROM movies m LEFT JOIN (SELECT movieId, count(*) AS n FROM interactions GROUP BY movieId) c
   ON c.movieId = m.movieId) AS pct_movies_below,
  (SELECT avg(CASE WHEN n < t.threshold THEN 1.0E0 ELSE 0.0E0 END) * 100
   FROM (SELECT userId, count(*) AS n FROM interactions GROUP BY userId)) AS pct_users_below
FROM (SELECT CAST(unnest([5, 10, 50, 100]) AS BIGINT) AS threshold) t""")
def q_longtail(spark, sf):
    return E.longtail_thresholds(S.interactions(spark, sf), S.movies(spark, sf))


@query("top_popular", code="A12", sql="""
SELECT row_number() OVER (ORDER BY n DESC, c.movieId) AS rank, c.movieId, m.title, n FROM (
  SELECT movieId, count(*) AS n FROM interactions GROUP BY movieId ORDER BY n DESC, movieId LIMIT 10) c
LEFT JOIN movies m ON m.movieId = c.movieId""")
def q_top_popular(spark, sf):
    from cinelake.functions.ranking import top_k_global
    c = S.interactions(spark, sf).groupBy("movieId").agg(F.count(F.lit(1)).alias("n"))
    top = top_k_global(c, 10, [F.col("n").desc(), F.col("movieId").asc()])
    return top.join(S.movies(spark, sf).select("movieId", "title"), "movieId", "left").select(
        "rank", "movieId", "title", "n")


@query("top_rated_min_support", code="A13", floats=("mean_rating",), sql="""
SELECT row_number() OVER (ORDER BY mean_rating DESC, c.movieId) AS rank, c.movieId, m.title, mean_rating, n FROM (
  SELECT movieId, avg(rating) AS mean_rating, count(*) AS n FROM interactions GROUP BY movieId
  HAVING count(*) >= 40 ORDER BY mean_rating DESC, movieId LIMIT 10) c
LEFT JOIN movies m ON m.movieId = c.movieId""")
def q_top_rated(spark, sf):
    """Support threshold 40 (the reference uses 1,000 on 32M ratings; it is a parameter)."""
    from cinelake.functions.ranking import top_k_global
    c = (S.interactions(spark, sf).groupBy("movieId")
         .agg(F.avg("rating").alias("mean_rating"), F.count(F.lit(1)).alias("n")).where("n >= 40"))
    top = top_k_global(c, 10, [F.col("mean_rating").desc(), F.col("movieId").asc()])
    return top.join(S.movies(spark, sf).select("movieId", "title"), "movieId", "left").select(
        "rank", "movieId", "title", "mean_rating", "n")


@query("genre_volume", code="A14", sql="""
SELECT genre, count(*) AS n_movies FROM (
  SELECT DISTINCT movieId, unnest(string_split(genres, '|')) AS genre FROM movies) GROUP BY genre""")
def q_genre_volume(spark, sf):
    return E.genre_volume(S.movies(spark, sf))


@query("genre_mean_rating", code="A15", floats=("mean_rating",), sql="""
SELECT g.genre, avg(i.rating) AS mean_rating, count(*) AS n_ratings
FROM interactions i JOIN (SELECT DISTINCT movieId, unnest(string_split(genres, '|')) AS genre FROM movies) g
  ON g.movieId = i.movieId GROUP BY g.genre""")
def q_genre_mean_rating(spark, sf):
    return E.genre_mean_rating(S.interactions(spark, sf), S.movies(spark, sf))


@query("yearly_activity", code="A16", sql="""
SELECT CAST(year(ts) AS BIGINT) AS year, count(*) AS n_ratings FROM interactions GROUP BY 1
ORDER BY 1 DESC LIMIT 10""")
def q_yearly_activity(spark, sf):
    c = S.interactions(spark, sf).groupBy(F.year("ts").alias("year")).agg(F.count(F.lit(1)).alias("n_ratings"))
    return c.orderBy(F.col("year").desc()).limit(10)


@query("popularity_vs_quality", code="A17", floats=("avg_mean", "std_mean", "corr_log_support_mean"), sql="""
SELECT bucket, count(*) AS n_movies, avg(mean) AS avg_mean, stddev_samp(mean) AS std_mean,
  (SELECT corr(ln(1 + n), mean) FROM (SELECT count(*) AS n, avg(rating) AS mean FROM interactions
                                       GROUP BY movieId)) AS corr_log_support_mean
FROM (SELECT CASE WHEN n >= 1 AND n < 5 THEN '1-4' WHEN n >= 5 AND n < 10 THEN '5-9'
                  WHEN n >= 10 AND n < 20 THEN '10-19' WHEN n >= 20 AND n < 50 THEN '20-49'
                  WHEN n >= 50 THEN '50+' END AS bucket, mean
      FROM (SELECT count(*) AS n, avg(rating) AS mean FROM interactions GROUP BY movieId))
GROUP BY bucket""")
def q_pop_vs_quality(spark, sf):
    return E.popularity_vs_quality(S.interactions(spark, sf))


@query("collect_sets", code="A18", sql="""
SELECT userId, list_sort(list(DISTINCT movieId)) AS seen FROM interactions GROUP BY userId""")
def q_collect_sets(spark, sf):
    return S.interactions(spark, sf).groupBy("userId").agg(F.array_sort(F.collect_set("movieId")).alias("seen"))


@query("seen_bitmaps", code="A18 (bitmaps)", sql="""
SELECT userId, CASE WHEN movieId > 0 THEN (movieId - 1) // 32768 + 1 ELSE movieId // 32768 END AS bucket, list_sort(list(DISTINCT movieId)) AS items FROM interactions GROUP BY 1, 2""")
def q_seen_bitmaps(spark, sf):
    """The sets as bitmaps of bounded size, read back as ids."""
    from cinelake.operators import seen as B
    return B.seen_lists(B.seen_bitmaps(S.interactions(spark, sf)))


@query("user_stats", code="A19", floats=("u_mean", "u_std"), sql="""
SELECT userId, avg(rating) AS u_mean, coalesce(stddev_samp(rating), 0.0E0) AS u_std, count(*) AS u_count
FROM interactions GROUP BY userId""")
def q_user_stats(spark, sf):
    return E.user_stats(S.interactions(spark, sf))


@query("movie_stats", code="A20", floats=("m_mean",), sql="""
SELECT movieId, avg(rating) AS m_mean, count(*) AS m_count FROM interactions GROUP BY movieId""")
def q_movie_stats(spark, sf):
    return E.movie_stats(S.interactions(spark, sf))


@query("sparsity", code="A21", floats=("density_pct", "sparsity_pct"), sql="""
SELECT n_users, n_items, nnz, nnz * 100.0E0 / (n_users * n_items) AS density_pct,
  100.0E0 - nnz * 100.0E0 / (n_users * n_items) AS sparsity_pct
FROM (SELECT count(DISTINCT userId) AS n_users, count(DISTINCT movieId) AS n_items, count(*) AS nnz
      FROM interactions)""")
def q_sparsity(spark, sf):
    return E.sparsity(S.interactions(spark, sf))


@query("catalog_insights", code="A22",
       floats=("global_mean", "median_movie_mean", "q90_movie_mean", "std_movie_mean"), sql="""
SELECT (SELECT count(*) FROM movies) AS n_catalog,
  (SELECT count(DISTINCT userId) FROM interactions) AS n_users,
  (SELECT count(*) FROM interactions) AS total_ratings,
  (SELECT avg(rating) FROM interactions) AS global_mean,
  count(*) AS n_rated_titles, quantile_cont(m_mean, 0.5) AS median_movie_mean,
  quantile_cont(m_mean, 0.9) AS q90_movie_mean, stddev_samp(m_mean) AS std_movie_mean
FROM (SELECT movieId, avg(rating) AS m_mean FROM interactions GROUP BY movieId)""")
def q_catalog_insights(spark, sf):
    r, m = S.interactions(spark, sf), S.movies(spark, sf)
    ms = E.movie_stats(r)
    a = ms.agg(F.count(F.lit(1)).alias("n_rated_titles"), F.stddev_samp("m_mean").alias("std_movie_mean"))
    p = exact_percentiles(ms, "m_mean", {"median_movie_mean": 0.5, "q90_movie_mean": 0.9})
    g = r.agg(F.countDistinct("userId").alias("n_users"), F.count(F.lit(1)).alias("total_ratings"),
              F.avg("rating").alias("global_mean"))
    c = m.agg(F.count(F.lit(1)).alias("n_catalog"))
    return c.crossJoin(g).crossJoin(a).join(p, F.lit(True), "left").select(            # one-row frames
        "n_catalog", "n_users", "total_ratings", "global_mean", "n_rated_titles", "median_movie_mean", "q90_movie_mean", "std_movie_mean")


@query("mean_histogram", code="A23", floats=("mean_bin",), sql="""
SELECT round(m_mean, 2) AS mean_bin, count(*) AS n FROM (
  SELECT movieId, avg(rating) AS m_mean FROM interactions GROUP BY movieId)
GROUP BY 1 ORDER BY 1 LIMIT 20""")
def q_mean_histogram(spark, sf):
    ms = E.movie_stats(S.interactions(spark, sf))
    h = ms.groupBy(F.round("m_mean", 2).alias("mean_bin")).agg(F.count(F.lit(1)).alias("n"))
    return h.orderBy("mean_bin").limit(20)


@query("profile_table", code="A24", floats=("min", "max", "mean", "std", "p25", "p50", "p75"), sql="""
SELECT 'ratings' AS table_name, column_name, "count", nulls, "distinct", "min", "max", mean, std, p25, p50, p75 FROM (
  SELECT 'userId' AS column_name, count(userId) AS "count", count_if(userId IS NULL) AS nulls,
    count(DISTINCT userId) AS "distinct", min(userId)::DOUBLE AS "min", max(userId)::DOUBLE AS "max",
    avg(userId::DOUBLE) AS mean, stddev_samp(userId::DOUBLE) AS std, quantile_cont(userId::DOUBLE, 0.25) AS p25,
    quantile_cont(userId::DOUBLE, 0.5) AS p50, quantile_cont(userId::DOUBLE, 0.75) AS p75 FROM interactions
  UNION ALL
  SELECT 'movieId', count(movieId), count_if(movieId IS NULL), count(DISTINCT movieId), min(movieId)::DOUBLE,
    max(movieId)::DOUBLE, avg(movieId::DOUBLE), stddev_samp(movieId::DOUBLE), quantile_cont(movieId::DOUBLE, 0.25),
    quantile_cont(movieId::DOUBLE, 0.5), quantile_cont(movieId::DOUBLE, 0.75) FROM interactions
  UNION ALL
  SELECT 'rating', count(rating), count_if(rating IS NULL), count(DISTINCT rating), min(rating), max(rating),
    avg(rating), stddev_samp(rating), quantile_cont(rating, 0.25), quantile_cont(rating, 0.5),
    quantile_cont(rating, 0.75) FROM interactions
  UNION ALL
  SELECT 'ts', count(ts), count_if(ts IS NULL), count(DISTINCT ts), NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM interactions)""")
def q_profile_table(spark, sf):
    return E.profile_table(S.interactions(spark, sf), "ratings")


def _profile_sql(table, view, column, kind):
    text = f"CAST({column} AS VARCHAR)"
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS data_type, count({column}) AS n_values,
  count_if({column} IS NULL) AS n_nulls, count(DISTINCT {column}) AS n_distinct, CAST(min({column}) AS VARCHAR) AS min_value,
  CAST(max({column}) AS VARCHAR) AS max_value,
  (SELECT string_agg(x || ' (' || n || ')', ', ' ORDER BY n DESC, x) FROM (SELECT {text} AS x, count(*) AS n FROM {view}
     WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY n DESC, x LIMIT 5)) AS top_values FROM {view}"""


@query("profile_columns", code="A24", sql="\nUNION ALL ".join(
    _profile_sql(t, v, c, k) for t, v, cols in COLUMN_TYPES for c, k in cols))
def q_profile_columns(spark, sf):
    """Types, ends and most frequent values of every column of the four tables."""
    return E.profile_columns(_canon(spark, sf))


@query("profile_sketches", code="A24 (sketches)")
def q_profile_sketches(spark, sf):
    """The same columns from mergeable sketches; their errors are held against
    the exact profile in the tests."""
    s = E.sketch_columns(_canon(spark, sf))
    return s.withColumn("top", F.array_join(F.transform("top", lambda r: F.format_string("%s (%d)", r["value"], r["n"])), ", "))


@query("genre_affinity", code="A26", floats=("affinity",), sql="""
SELECT i.userId, g.genre, sum(i.rating - 2.5E0) / max(n.n_u) AS affinity
FROM interactions i
JOIN (SELECT DISTINCT movieId, trim(x) AS genre FROM (SELECT movieId, unnest(string_split(genres, '|')) AS x FROM movies)
      WHERE trim(x) <> '') g ON g.movieId = i.movieId
JOIN (SELECT userId, count(*) AS n_u FROM interactions GROUP BY userId) n ON n.userId = i.userId
GROUP BY i.userId, g.genre""")
def q_genre_affinity(spark, sf):
    return E.genre_affinity(S.interactions(spark, sf), S.movies(spark, sf))


@query("datetime_parts", code="F1/F2", floats=("month_sin", "month_cos"), sql="""
SELECT userId, movieId, CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month,
  CAST(isodow(ts) - 1 AS BIGINT) AS weekday, CAST(hour(ts) AS BIGINT) AS hour,
  sin(2 * pi() * month(ts) / 12.0E0) AS month_sin, cos(2 * pi() * month(ts) / 12.0E0) AS month_cos
FROM interactions""")
def q_datetime_parts(spark, sf):
    return E.datetime_parts(S.interactions(spark, sf))


@query("movie_age", code="F3", sql="""
SELECT i.userId, i.movieId,
  year(i.ts) - TRY_CAST(nullif(regexp_extract(m.title, '\\((\\d{4})\\)$', 1), '') AS BIGINT) AS movie_age
FROM interactions i LEFT JOIN movies m ON m.movieId = i.movieId""")
def q_movie_age(spark, sf):
    return E.movie_age(S.interactions(spark, sf), S.movies(spark, sf))


@query("user_tenure", code="W8", sql=f"""
SELECT userId, movieId, {EPOCH} - min({EPOCH}) OVER (PARTITION BY userId) AS tenure_s FROM interactions""")
def q_user_tenure(spark, sf):
    return E.user_tenure(S.interactions(spark, sf))


@query("rating_gap", code="W9", floats=("mean_gap_days",), sql=f"""
SELECT userId, avg(gap) / 86400.0E0 AS mean_gap_days FROM (
  SELECT userId, {EPOCH} - lag({EPOCH}) OVER (PARTITION BY userId ORDER BY ts, movieId) AS gap FROM interactions)
GROUP BY userId""")
def q_rating_gap(spark, sf):
    return E.rating_gap(S.interactions(spark, sf))


@query("standardize", code="F7", floats=("u_mean_z", "u_count_z", "u_mean_rz", "u_count_rz"), sql="""
SELECT userId,
  (u_mean - avg(u_mean) OVER ()) / stddev_pop(u_mean) OVER () AS u_mean_z,
  (u_count - avg(u_count) OVER ()) / stddev_pop(u_count) OVER () AS u_count_z,
  (u_mean - quantile_cont(u_mean, 0.5) OVER ())
    / (quantile_cont(u_mean, 0.75) OVER () - quantile_cont(u_mean, 0.25) OVER ()) AS u_mean_rz,
  (u_count - quantile_cont(u_count, 0.5) OVER ())
    / (quantile_cont(u_count, 0.75) OVER () - quantile_cont(u_count, 0.25) OVER ()) AS u_count_rz
FROM (SELECT userId, avg(rating) AS u_mean, CAST(count(*) AS DOUBLE) AS u_count FROM interactions GROUP BY userId)""")
def q_standardize(spark, sf):
    from cinelake.session import written
    us = written(E.user_stats(S.interactions(spark, sf)).withColumn("u_count", F.col("u_count").cast("double")), "user-stats")   # read by both scalers
    z = E.standardize(us, ["u_mean", "u_count"], "userId")
    rz = E.standardize(us, ["u_mean", "u_count"], "userId", robust=True).select(
        "userId", F.col("u_mean_z").alias("u_mean_rz"), F.col("u_count_z").alias("u_count_rz"))
    return z.join(rz, "userId")


@query("l2_normalise_rows", code="F8", floats=("w",), sql="""
SELECT userId, movieId, rating / sqrt(sum(rating * rating) OVER (PARTITION BY userId)) AS w FROM interactions""")
def q_l2_normalise(spark, sf):
    r = S.interactions(spark, sf).select("userId", "movieId", F.col("rating").alias("w"))
    return E.l2_normalise(r, "userId", "w")
