"""Registered queries: Bayesian popularity, onboarding, discovery lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinelake.operators import popularity as P
from cinelake.plans.registry import query
from cinelake.sources import tables as S


@query("bayesian_popularity", code="R10", floats=("mean_rating", "score"), sql="""
SELECT movieId, n_ratings, mean_rating, score FROM pop""")
def q_bayesian_popularity(spark, sf):
    return P.bayesian_popularity(S.interactions(spark, sf))


@query("popular_top10", code="O1", floats=("mean_rating", "score"), sql="""
SELECT row_number() OVER (ORDER BY score DESC, t.movieId) AS rank, t.movieId, m.title,
       n_ratings, mean_rating, score
FROM (SELECT * FROM pop ORDER BY score DESC, movieId LIMIT 10) t
LEFT JOIN movies m ON m.movieId = t.movieId""")
def q_popular_top10(spark, sf):
    return P.top_popular(S.interactions(spark, sf), S.movies(spark, sf), k=10)


@query("rank_items", code="W11", floats=("score",), sql="""
SELECT movieId, score, row_number() OVER (ORDER BY score DESC, movieId) AS rank FROM pop""")
def q_rank_items(spark, sf):
    from cinelake.functions.ranking import global_rank, order_cols
    pop = P.bayesian_popularity(S.interactions(spark, sf)).select("movieId", "score")
    return global_rank(pop, order_cols())


@query("popularity_unseen_top10", code="R10+J5", floats=("score",), sql="""
SELECT userId, rank, movieId, score FROM (
  SELECT u.userId, p.movieId, p.score,
         row_number() OVER (PARTITION BY u.userId ORDER BY p.score DESC, p.movieId) AS rank
  FROM (SELECT DISTINCT userId FROM interactions) u CROSS JOIN pop p
  WHERE NOT EXISTS (SELECT 1 FROM interactions i WHERE i.userId = u.userId AND i.movieId = p.movieId)
) t WHERE rank <= 10""")
def q_popularity_unseen(spark, sf):
    r = S.interactions(spark, sf)
    return P.popularity_for_users(r.select("userId").distinct(), r, k=10, exclude_seen=True)


ONBOARD_SQL = """
, firstm AS (
  SELECT userId, movieId AS first_mid FROM (
    SELECT userId, movieId, row_number() OVER (PARTITION BY userId ORDER BY ts, movieId) AS rn
    FROM interactions) WHERE rn = 1
), req_raw AS (
  SELECT f.userId AS req_id, unnest(string_split(m.genres, '|')) AS g,
         unnest(range(1, len(string_split(m.genres, '|')) + 1)) AS gpos
  FROM firstm f JOIN movies m ON m.movieId = f.first_mid
), req AS (
  SELECT req_id, trim(g) AS genre, min(gpos) AS gpos FROM req_raw
  WHERE trim(g) <> '' AND trim(g) <> '(no genres listed)' GROUP BY req_id, trim(g)
), gm AS (
  SELECT DISTINCT movieId, trim(g) AS genre FROM (
    SELECT movieId, unnest(string_split(genres, '|')) AS g FROM movies)
  WHERE trim(g) <> '' AND trim(g) <> '(no genres listed)'
), buckets AS (
  SELECT genre, movieId, score, row_number() OVER (PARTITION BY genre ORDER BY score DESC, movieId) AS pos
  FROM (SELECT gm.genre, gm.movieId, coalesce(p.score, 0.0E0) AS score
        FROM gm LEFT JOIN pop p ON p.movieId = gm.movieId)
), firsts AS (
  SELECT * FROM (
    SELECT r.req_id, r.gpos, b.pos, b.movieId, b.score,
           row_number() OVER (PARTITION BY r.req_id, b.movieId ORDER BY b.pos, r.gpos) AS dup
    FROM req r JOIN buckets b ON b.genre = r.genre) WHERE dup = 1
), rounds AS (
  SELECT req_id, pos FROM (
    SELECT req_id, pos, coalesce(sum(n) OVER (PARTITION BY req_id ORDER BY pos
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM (SELECT req_id, pos, count(*) AS n FROM firsts GROUP BY req_id, pos)) WHERE before < 10
), picked AS (
  SELECT f.req_id, row_number() OVER (PARTITION BY f.req_id ORDER BY f.pos, f.gpos) AS rank, f.movieId, f.score
  FROM firsts f JOIN rounds r ON r.req_id = f.req_id AND r.pos = f.pos
)
SELECT * FROM picked
UNION ALL
SELECT u.req_id, t.rank, t.movieId, t.score
FROM (SELECT userId AS req_id FROM firstm WHERE userId NOT IN (SELECT req_id FROM picked)) u
CROSS JOIN (SELECT row_number() OVER (ORDER BY score DESC, movieId) AS rank, movieId, score
            FROM (SELECT * FROM pop ORDER BY score DESC, movieId LIMIT 10)) t
"""


@query("genre_onboarding", code="R11/W6", floats=("score",), sql=ONBOARD_SQL)
def q_genre_onboarding(spark, sf):
    r, m = S.interactions(spark, sf), S.movies(spark, sf)
    return P.genre_onboarding(P.first_rated_genres(r, m), m, r, k=10)


ONBOARD_UNSEEN_SQL = (ONBOARD_SQL
    .replace("FROM req r JOIN buckets b ON b.genre = r.genre)", """FROM req r JOIN buckets b ON b.genre = r.genre
    WHERE NOT EXISTS (SELECT 1 FROM interactions i WHERE i.userId = r.req_id AND i.movieId = b.movieId))""")
    .split("UNION ALL")[0] + """UNION ALL
SELECT req_id, rank, movieId, score FROM (
  SELECT u.req_id, p.movieId, p.score, row_number() OVER (PARTITION BY u.req_id ORDER BY p.score DESC, p.movieId) AS rank
  FROM (SELECT userId AS req_id FROM firstm WHERE userId NOT IN (SELECT req_id FROM picked)) u CROSS JOIN pop p
  WHERE NOT EXISTS (SELECT 1 FROM interactions i WHERE i.userId = u.req_id AND i.movieId = p.movieId))
WHERE rank <= 10""")


@query("genre_onboarding_unseen", code="R11", floats=("score",), sql=ONBOARD_UNSEEN_SQL)
def q_genre_onboarding_unseen(spark, sf):
    """Genre onboarding that leaves out what each user has rated."""
    from cinelake.session import written
    r, m = written(S.interactions(spark, sf), "interactions"), S.movies(spark, sf)      # read by requests, scores and exclusions
    return P.genre_onboarding(P.first_rated_genres(r, m), m, r, k=10, exclude=r.select(F.col("userId").alias("req_id"), "movieId"))


@query("popular_seeds", code="P14", floats=("score",), sql="""
SELECT row_number() OVER (ORDER BY score DESC, movieId) AS rank, movieId, title, score FROM (
  SELECT p.movieId, m.title, p.score FROM pop p JOIN movies m ON m.movieId = p.movieId
  ORDER BY p.score DESC, p.movieId LIMIT 250)""")
def q_popular_seeds(spark, sf):
    return P.popular_seeds(S.interactions(spark, sf), S.movies(spark, sf), n=250)


FILTER_COLS = """rank, movieId, title, year, score, quality, mean_rating, n_ratings"""
CATALOG_SQL = """
, cat AS (
  SELECT movieId, title,
    TRY_CAST(nullif(regexp_extract(title, '\\((\\d{4})\\)$', 1), '') AS INTEGER) AS year,
    list_filter(list_transform(string_split(coalesce(genres, ''), '|'), lambda g: trim(g)),
                lambda g: g <> '' AND g <> '(no genres listed)') AS genre_list
  FROM movies
), decorated AS (
  SELECT c.movieId, c.title, CAST(c.year AS BIGINT) AS year, c.genre_list,
         coalesce(p.score, (SELECT avg(rating) FROM interactions)) AS quality,
         coalesce(p.mean_rating, (SELECT avg(rating) FROM interactions)) AS mean_rating,
         CAST(coalesce(p.n_ratings, 0) AS BIGINT) AS n_ratings
  FROM cat c LEFT JOIN pop p ON p.movieId = c.movieId
)"""


@query("trending", code="P16", floats=("score", "quality", "mean_rating"), sql=CATALOG_SQL + f"""
SELECT row_number() OVER (ORDER BY score DESC, movieId) AS {FILTER_COLS} FROM (
  SELECT d.movieId, d.title, d.year, p.score, d.quality, d.mean_rating, d.n_ratings
  FROM pop p JOIN decorated d ON d.movieId = p.movieId
  WHERE list_has_any(d.genre_list, ['SMALL', 'LARGE', 'ECONOMY'])
    AND (d.year IS NULL OR d.year BETWEEN 1960 AND 1990) AND d.quality >= 3.0E0
  ORDER BY p.score DESC, p.movieId LIMIT 10)""")
def q_trending(spark, sf):
    return P.trending(S.interactions(spark, sf), S.movies(spark, sf), limit=10,
                      selected_genres=["SMALL", "LARGE", "ECONOMY"], year_range=(1960, 1990), min_quality=3.0)


@query("hidden_gems", code="P17", floats=("score", "quality", "mean_rating"), sql=CATALOG_SQL + f"""
SELECT row_number() OVER (ORDER BY score DESC, movieId) AS {FILTER_COLS} FROM (
  SELECT d.movieId, d.title, d.year, p.score, d.quality, d.mean_rating, d.n_ratings
  FROM pop p JOIN decorated d ON d.movieId = p.movieId
  WHERE p.n_ratings >= 3
    AND p.n_ratings <= greatest(100, CAST(floor((SELECT quantile_cont(n_ratings, 0.35) FROM pop)) AS BIGINT))
  ORDER BY p.score DESC, p.movieId LIMIT 10)""")
def q_hidden_gems(spark, sf):
    return P.hidden_gems(S.interactions(spark, sf), S.movies(spark, sf), limit=10)


@query("genre_facets", code="P18", sql="""
SELECT DISTINCT trim(x.g) AS genre,
  (SELECT min(TRY_CAST(nullif(regexp_extract(title, '\\((\\d{4})\\)$', 1), '') AS INTEGER)) FROM movies) AS year_min,
  (SELECT max(TRY_CAST(nullif(regexp_extract(title, '\\((\\d{4})\\)$', 1), '') AS INTEGER)) FROM movies) AS year_max
FROM movies m, unnest(string_split(m.genres, '|')) AS x(g)
WHERE trim(x.g) <> '' AND trim(x.g) <> '(no genres listed)'""")
def q_genre_facets(spark, sf):
    return P.genre_facets(S.movies(spark, sf))


@query("round_robin_merge", code="W6", sql=ONBOARD_SQL.split("\n), picked AS (")[0] + """
)
SELECT f.req_id, row_number() OVER (PARTITION BY f.req_id ORDER BY f.pos, f.gpos) AS rank, f.movieId,
  f.pos AS round
FROM firsts f JOIN rounds r ON r.req_id = f.req_id AND r.pos = f.pos""")
def q_round_robin_merge(spark, sf):
    """The interleaving behind genre onboarding, with the round of every pick
    (the last round may overshoot k)."""
    from cinelake.functions.ranking import top_k_per_group
    r, m = S.interactions(spark, sf), S.movies(spark, sf)
    picked = P.round_robin_merge(P.first_places(P.first_rated_genres(r, m), P.genre_buckets(m, r, 10)), 10)
    out = top_k_per_group(picked, "req_id", None, [F.col("pos"), F.col("gpos")])
    return out.select("req_id", "rank", "movieId", F.col("pos").alias("round"))
