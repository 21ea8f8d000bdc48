"""Registered queries: scans, projections, filters, joins, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinelake.operators import prep as R
from cinelake.plans.registry import query
from cinelake.sources import tables as S

YEAR_SQL = "TRY_CAST(nullif(regexp_extract(title, '\\((\\d{4})\\)$', 1), '') AS BIGINT)"
YEAR_TRIM_SQL = "TRY_CAST(nullif(regexp_extract(title, '\\((\\d{4})\\)\\s*$', 1), '') AS BIGINT)"
CLEAN_SQL = "trim(regexp_replace(title, '\\s*\\(\\d{4}\\)$', ''))"
EPOCH_SQL = "CAST(floor(epoch({c})) AS BIGINT)"
HASH2_SQL = "(((movieId * 2654435761) + ((userId * 2654435761 + 42) % 4294967296)) % 4294967296)"
TAGS_CLEAN_SQL = """
, tclean AS (SELECT userId, movieId, ts, trim(lower(tag)) AS tag_clean FROM tags WHERE tag IS NOT NULL)
, tfreq AS (SELECT tag_clean FROM tclean GROUP BY tag_clean HAVING count(*) >= 2)
, tagg AS (
  SELECT movieId, string_agg(tag_clean, ' ' ORDER BY userId, ts, tag_clean) AS combined_tags
  FROM tclean WHERE tag_clean IN (SELECT tag_clean FROM tfreq) GROUP BY movieId)"""


@query("scan_movies", code="S1", sql=f"""
SELECT movieId, title, genres, {YEAR_SQL} AS year, {CLEAN_SQL} AS clean_title FROM movies""")
def q_scan_movies(spark, sf):
    return R.enrich_movies(S.movies(spark, sf))


@query("scan_ratings", code="S2", floats=("rating",), sql=f"""
SELECT userId, movieId, rating, {EPOCH_SQL.format(c='ts')} AS timestamp FROM interactions""")
def q_scan_ratings(spark, sf):
    return R.ratings_with_epoch(S.interactions(spark, sf))


@query("scan_tags", code="S3", sql=TAGS_CLEAN_SQL + "\nSELECT movieId, combined_tags FROM tagg")
def q_scan_tags(spark, sf):
    return R.load_tags(S.tags(spark, sf), min_tag_freq=2)


@query("scan_links", code="S4", floats=("tmdbId",), sql="SELECT movieId, imdbId, tmdbId FROM links")
def q_scan_links(spark, sf):
    return S.links(spark, sf)


@query("bounded_read", code="S5", floats=("rating",), sql=f"""
SELECT userId, movieId, rating, {EPOCH_SQL.format(c='ts')} AS timestamp FROM interactions
ORDER BY userId, movieId, ts LIMIT 1000""")
def q_bounded_read(spark, sf):
    return R.ratings_with_epoch(R.bounded_read(S.interactions(spark, sf), 1000))


@query("fraction_sample", code="S6", floats=("rating",), sql=f"""
SELECT userId, movieId, rating FROM interactions
WHERE {HASH2_SQL} < CAST(0.1E0 * 4294967296 AS BIGINT)""")
def q_fraction_sample(spark, sf):
    return R.fraction_sample(S.interactions(spark, sf), 0.1).select("userId", "movieId", "rating")


@query("content_metadata", code="S7/J1/P4/P5", sql=TAGS_CLEAN_SQL + f"""
SELECT m.movieId, title, genres, {YEAR_SQL} AS year, {CLEAN_SQL} AS clean_title,
  coalesce(t.combined_tags, '') AS combined_tags,
  replace(replace(genres, '|', ' '), '(no genres listed)', '') AS genre_tokens,
  trim(concat_ws(' ', {CLEAN_SQL}, replace(replace(genres, '|', ' '), '(no genres listed)', ''),
                 coalesce(t.combined_tags, ''))) AS content_soup
FROM movies m LEFT JOIN tagg t ON t.movieId = m.movieId""")
def q_content_metadata(spark, sf):
    return R.content_metadata(S.movies(spark, sf), S.tags(spark, sf))


@query("hydrate_popularity", code="S11/S12", floats=("mean_rating",), sql="""
SELECT movieId, count(*) AS n_ratings, avg(rating) AS mean_rating FROM interactions GROUP BY movieId""")
def q_hydrate_popularity(spark, sf):
    """Popularity statistics of a loaded bundle, over all ratings."""
    return S.interactions(spark, sf).groupBy("movieId").agg(F.count(F.lit(1)).alias("n_ratings"), F.avg("rating").alias("mean_rating"))


@query("extract_year", code="P1/P2", sql=f"""
SELECT movieId, {YEAR_SQL} AS year, {YEAR_TRIM_SQL} AS year_trim, {CLEAN_SQL} AS clean_title FROM movies""")
def q_extract_year(spark, sf):
    from cinelake.functions.text import clean_title, extract_year
    m = S.movies(spark, sf)
    return m.select("movieId", extract_year(F.col("title")).alias("year"),
                    extract_year(F.col("title"), trim_tail=True).alias("year_trim"),
                    clean_title(F.col("title")).alias("clean_title"))


GENRE_EXPLODE_SQL = """
SELECT DISTINCT movieId, trim(g) AS genre FROM (SELECT movieId, unnest(string_split(genres, '|')) AS g FROM movies)
WHERE trim(g) <> '' AND trim(g) <> '(no genres listed)'"""


@query("split_genres", code="P3", sql=GENRE_EXPLODE_SQL)
def q_split_genres(spark, sf):
    return R.explode_genres(S.movies(spark, sf))


@query("normalise_tags", code="P6", sql="""
SELECT userId, movieId, trim(lower(tag)) AS tag_clean FROM tags WHERE tag IS NOT NULL""")
def q_normalise_tags(spark, sf):
    return R.normalise_tags(S.tags(spark, sf)).select("userId", "movieId", "tag_clean")


@query("min_tag_freq", code="P7", sql="""
SELECT trim(lower(tag)) AS tag_clean, count(*) AS n FROM tags WHERE tag IS NOT NULL
GROUP BY 1 HAVING count(*) >= 2""")
def q_min_tag_freq(spark, sf):
    return R.tag_frequencies(S.tags(spark, sf)).where("n >= 2")


@query("combine_tags_raw", code="P8", sql="""
SELECT movieId, string_agg(tag, ' ' ORDER BY userId, ts, tag) AS combined_tags
FROM tags WHERE tag IS NOT NULL GROUP BY movieId""")
def q_combine_tags_raw(spark, sf):
    t = S.tags(spark, sf).where(F.col("tag").isNotNull())
    return R.combine_tags(t, tag_col="tag")


@query("kcore_filter", code="P9", floats=("rating",), sql="""
SELECT userId, movieId, rating FROM interactions
WHERE userId IN (SELECT userId FROM interactions GROUP BY userId HAVING count(*) >= 40)
  AND movieId IN (SELECT movieId FROM interactions GROUP BY movieId HAVING count(*) >= 30)""")
def q_kcore_filter(spark, sf):
    return R.kcore_filter(S.interactions(spark, sf), 40, 30).select("userId", "movieId", "rating")


@query("binarize_relevance", code="P10", floats=("rating",), sql="""
SELECT userId, movieId, rating, CAST(rating >= 4.0E0 AS BIGINT) AS label FROM interactions""")
def q_binarize(spark, sf):
    return R.binarize(S.interactions(spark, sf), 4.0)


@query("search_regex", code="P12", sql="""
SELECT movieId, title, genres FROM movies WHERE regexp_matches(title, 'blue.*\\(19[6-7]', 'i')
ORDER BY movieId LIMIT 10""")
def q_search_regex(spark, sf):
    return R.search_regex(S.movies(spark, sf), r"blue.*\(19[6-7]")


@query("search_literal", code="P13", sql="""
SELECT movieId, title, genres FROM movies WHERE contains(lower(title), lower('Red Widget'))
ORDER BY movieId LIMIT 250""")
def q_search_literal(spark, sf):
    return R.search_literal(S.movies(spark, sf), "Red Widget")


@query("invalid_values", code="P19", sql="""
SELECT count(*) AS n_rows, count_if(isnan(rating)) AS n_nan, count_if(isinf(rating)) AS n_inf,
  count_if(NOT isnan(rating) AND (rating < 0.5 OR rating > 5.0)) AS n_out_of_range,
  count_if(NOT isnan(rating) AND (rating * 2) % 1 <> 0) AS n_off_step,
  count_if(rating IS NULL) AS n_null
FROM rating_feed""")
def q_invalid_values(spark, sf):
    return R.invalid_values(S.rating_feed(spark, sf))


@query("join_movies_links", code="J2", floats=("tmdbId",), sql="""
SELECT m.movieId, m.title, l.imdbId, l.tmdbId FROM movies m LEFT JOIN links l ON l.movieId = m.movieId""")
def q_join_movies_links(spark, sf):
    return S.movies(spark, sf).join(S.links(spark, sf), "movieId", "left").select(
        "movieId", "title", "imdbId", "tmdbId")


@query("join_ratings_movies", code="J3", floats=("rating",), sql="""
SELECT i.userId, i.movieId, i.rating, m.title, m.genres FROM interactions i
LEFT JOIN movies m ON m.movieId = i.movieId""")
def q_join_ratings_movies(spark, sf):
    # movies is the dimension side; AQE / the size threshold decides broadcast.
    return S.interactions(spark, sf).join(S.movies(spark, sf), "movieId", "left").select(
        "userId", "movieId", "rating", "title", "genres")


@query("semi_join_membership", code="J4", sql="""
SELECT userId, count(*) AS n_kept FROM interactions
WHERE movieId IN (SELECT movieId FROM interactions GROUP BY movieId HAVING count(*) >= 30)
GROUP BY userId""")
def q_semi_join(spark, sf):
    r = S.interactions(spark, sf)
    valid = r.groupBy("movieId").count().where("count >= 30").select("movieId")
    return r.join(valid, "movieId", "left_semi").groupBy("userId").agg(F.count(F.lit(1)).alias("n_kept"))


@query("multi_key_sort", code="O3", floats=("rating",), sql="""
SELECT userId, movieId, rating, row_number() OVER (PARTITION BY userId ORDER BY ts, movieId) AS seq
FROM interactions""")
def q_multi_key_sort(spark, sf):
    return R.user_sequence(S.interactions(spark, sf))


@query("intersect_genres", code="O5", sql="""
SELECT a.movieId AS movieId, count(*) AS n_overlapping FROM movies a
JOIN (SELECT DISTINCT genre FROM (
       SELECT trim(unnest(string_split(genres, '|'))) AS genre FROM movies WHERE movieId IN (
         SELECT movieId FROM pop ORDER BY score DESC, movieId LIMIT 1))) s
  ON list_contains(list_transform(string_split(a.genres, '|'), lambda g: trim(g)), s.genre)
GROUP BY a.movieId""")
def q_intersect_genres(spark, sf):
    """Catalog movies sharing >= 1 genre with the most popular movie, and how many."""
    from cinelake.operators.popularity import bayesian_popularity
    from cinelake.functions.ranking import order_cols, top_k_global
    from cinelake.functions.text import genre_array
    m = S.movies(spark, sf)
    top = top_k_global(bayesian_popularity(S.interactions(spark, sf)), 1, order_cols()).select("movieId")
    seed = m.join(top, "movieId", "left_semi").select(F.array_distinct(genre_array(F.col("genres"), False))
                                                      .alias("seed_genres"))
    cand = m.select("movieId", F.array_distinct(genre_array(F.col("genres"), False)).alias("g"))
    j = cand.crossJoin(F.broadcast(seed))  # one seed row
    j = j.where(F.arrays_overlap("g", "seed_genres"))
    return j.select("movieId", F.size(F.array_intersect("g", "seed_genres")).cast("bigint").alias("n_overlapping"))


@query("except_seen", code="O6/J5", sql="""
SELECT userId, count(*) AS n_unseen_top50 FROM
  (SELECT DISTINCT userId FROM interactions) u,
  (SELECT movieId FROM pop ORDER BY score DESC, movieId LIMIT 50) t
WHERE NOT EXISTS (SELECT 1 FROM interactions i WHERE i.userId = u.userId AND i.movieId = t.movieId)
GROUP BY userId""")
def q_except_seen(spark, sf):
    """Per user, how many of the 50 most popular movies are still unseen: the
    bitmaps of what a user has seen AND those of the 50."""
    from cinelake.operators import seen as B
    from cinelake.operators.popularity import bayesian_popularity
    from cinelake.functions.ranking import order_cols, top_k_global
    r = S.interactions(spark, sf)
    top = top_k_global(bayesian_popularity(r), 50, order_cols()).select("movieId")
    left = B.unseen_counts(B.seen_bitmaps(r), r.select("userId").distinct(), top)
    return left.where("n_unseen > 0").select("userId", F.col("n_unseen").alias("n_unseen_top50"))


@query("concat_partitions", code="O8/O4", sql="""
SELECT source, count(*) AS n, count(DISTINCT movieId) AS n_movies FROM (
  SELECT 'ratings' AS source, movieId FROM interactions
  UNION ALL SELECT 'tags' AS source, movieId FROM tags) GROUP BY source
UNION ALL
SELECT 'union_distinct' AS source, count(*) AS n, count(*) AS n_movies FROM (
  SELECT movieId FROM interactions UNION SELECT movieId FROM tags)""")
def q_concat_partitions(spark, sf):
    r = S.interactions(spark, sf).select(F.lit("ratings").alias("source"), "movieId")
    t = S.tags(spark, sf).select(F.lit("tags").alias("source"), "movieId")
    both = r.unionByName(t)
    per = both.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("movieId").alias("n_movies"))
    u = both.select("movieId").distinct().agg(F.count(F.lit(1)).alias("n"))
    return per.unionByName(u.select(F.lit("union_distinct").alias("source"), "n", F.col("n").alias("n_movies")))


@query("decorate_results", code="J10", floats=("score",), sql="""
SELECT r.rank, r.movieId, r.score, coalesce(m.title, 'Unknown') AS title, coalesce(m.genres, '') AS genres
FROM (SELECT row_number() OVER (ORDER BY score DESC, movieId) AS rank, movieId, score
      FROM (SELECT movieId, score FROM pop UNION ALL SELECT -1 - movieId, score FROM pop WHERE movieId < 5)
      ) r LEFT JOIN movies m ON m.movieId = r.movieId""")
def q_decorate(spark, sf):
    """Ranked ids, some unknown to the catalog (negative ids), decorated."""
    from cinelake.operators.popularity import bayesian_popularity
    from cinelake.functions.ranking import global_rank, order_cols
    pop = bayesian_popularity(S.interactions(spark, sf)).select("movieId", "score")
    ids = pop.unionByName(pop.where("movieId < 5").select((F.lit(-1) - F.col("movieId")).alias("movieId"), "score"))
    ranked = global_rank(ids, order_cols())
    return R.decorate(ranked, S.movies(spark, sf)).select("rank", "movieId", "score", "title", "genres")
