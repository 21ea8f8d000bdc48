"""Bayesian popularity (R10), genre onboarding (R11 / W6) and discovery lists
(P14-P18).

All of these are per-movie aggregates followed by ordered limits or windows.
The global mean C is a one-row scalar aggregate joined back with an explicit
broadcast: its size is fixed at one row whatever the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.functions.ranking import (first_k_unseen, global_rank, order_cols, rank_within, top_k_global,
                                        top_k_per_group)
from cinelake.functions.text import extract_year, genre_array
from cinelake.session import written


def global_mean(ratings: DataFrame) -> DataFrame:
    """One-row frame ``(C)``."""
    return ratings.agg(F.avg("rating").alias("C"))


def bayesian_popularity(ratings: DataFrame, m: float = 50.0) -> DataFrame:
    """``v/(v+m)*R + m/(v+m)*C`` per rated movie.

    Columns: movieId, n_ratings, mean_rating, score.
    """
    stats = ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("n_ratings"),
                                           F.avg("rating").alias("mean_rating"))
    v, R = F.col("n_ratings"), F.col("mean_rating")
    mm = F.lit(float(m))
    return (stats.crossJoin(F.broadcast(global_mean(ratings)))
            .select("movieId", "n_ratings", "mean_rating",
                    (v / (v + mm) * R + mm / (v + mm) * F.col("C")).alias("score")))


def top_popular(ratings: DataFrame, movies: DataFrame, k: int = 10, m: float = 50.0) -> DataFrame:
    """Global top-k by Bayesian score with titles (O1 over R10); the ordered
    limit plans as ``TakeOrderedAndProject``."""
    top = top_k_global(bayesian_popularity(ratings, m), k, order_cols())
    return (top.join(movies.select("movieId", "title"), "movieId", "left")
            .select("rank", "movieId", "title", "n_ratings", "mean_rating", "score"))


def popularity_for_users(users: DataFrame, ratings: DataFrame, k: int = 10, m: float = 50.0,
                         exclude_seen: bool = False) -> DataFrame:
    """The popularity recommender as a set job: ``(userId, rank, movieId, score)``.

    Without exclusion every user gets the same k rows (k rows broadcast: a
    proven bound).  With exclusion the catalog gets one global rank and each
    user's answer is the k smallest ranks outside the user's history
    (``first_k_unseen``), so no user x catalog product is formed.
    """
    pop = bayesian_popularity(ratings, m).select("movieId", "score")
    if not exclude_seen:
        top = top_k_global(pop, k, order_cols())
        return users.select("userId").crossJoin(F.broadcast(top)).select("userId", "rank", "movieId", "score")
    ranked = global_rank(pop, order_cols(), rank_col="pop_rank")
    seen = (ratings.select("userId", "movieId").join(users.select("userId"), "userId", "left_semi")
            .join(ranked.select("movieId", "pop_rank"), "movieId"))
    picks = first_k_unseen(seen.select("userId", "pop_rank"), users, k)
    return picks.join(ranked, "pop_rank").select("userId", "rank", "movieId", "score")


def genre_buckets(movies: DataFrame, ratings: DataFrame, depth: int, m: float = 50.0) -> DataFrame:
    """First ``depth`` movies of every genre bucket by Bayesian score (unrated
    movies score 0.0, sentinel dropped); ``pos`` is 1-based."""
    pop = bayesian_popularity(ratings, m).select("movieId", "score")
    g = movies.select("movieId", F.explode(F.array_distinct(genre_array(F.col("genres")))).alias("genre"))
    g = g.join(pop, "movieId", "left").fillna(0.0, subset=["score"])
    return top_k_per_group(g, "genre", depth, order_cols(), rank_col="pos")


def genre_places(movies: DataFrame, ratings: DataFrame, m: float = 50.0, pop: DataFrame | None = None) -> DataFrame:
    """(genre, pos, movieId, score): every movie's place in its genre buckets,
    range-partitioned so that a large genre is many tasks' work. ``pop``: the
    scores, if they are there already."""
    pop = bayesian_popularity(ratings, m).select("movieId", "score") if pop is None else pop
    g = movies.select("movieId", F.explode(F.array_distinct(genre_array(F.col("genres")))).alias("genre"))
    g = g.join(pop, "movieId", "left").fillna(0.0, subset=["score"])
    return rank_within(g, "genre", order_cols(), out="pos")


def first_places(requests: DataFrame, buckets: DataFrame) -> DataFrame:
    """(req_id, gpos, pos, movieId, score): the bucket rows of every preferred genre."""
    req = requests.select("req_id", F.posexplode(F.array_distinct("genres")).alias("gpos", "genre"))
    return req.join(buckets, "genre").select("req_id", "gpos", "pos", "movieId", "score")


def open_places(requests: DataFrame, places: DataFrame, exclude: DataFrame, k: int) -> DataFrame:
    """(req_id, gpos, pos, movieId, score): for every preferred genre the places
    a request can need, without its excluded movies. From a genre with s of them
    the first R places give R - s movies, so k are taken by round k + s at the
    latest; a request meets k + s places of a genre, s the most it has in one."""
    req = requests.select("req_id", F.posexplode(F.array_distinct("genres")).alias("gpos", "genre"))
    held = (exclude.join(places.select("movieId", "genre"), "movieId").join(req.select("req_id", "genre"), ["req_id", "genre"], "left_semi")
            .groupBy("req_id", "genre").agg(F.count(F.lit(1)).alias("s")).groupBy("req_id").agg(F.max("s").alias("s")))
    sizes = places.groupBy("genre").agg(F.max("pos").alias("size"))
    need = req.join(sizes, "genre").join(held, "req_id", "left")
    last = F.least(F.col("size"), F.lit(k) + F.coalesce("s", F.lit(0)))
    wanted = need.select("req_id", "gpos", "genre", F.explode(F.sequence(F.lit(1).cast("bigint"), last.cast("bigint"))).alias("pos"))
    return (wanted.join(places, ["genre", "pos"]).join(exclude, ["req_id", "movieId"], "left_anti")
            .select("req_id", "gpos", "pos", "movieId", "score"))


def round_robin_merge(cand: DataFrame, k: int) -> DataFrame:
    """Interleave each request's genre buckets, given as (req_id, gpos, pos,
    movieId, score).  Round = position in the bucket; within a round genres go
    in preference order; a movie already taken in an earlier (round, genre) is
    skipped; rounds run while fewer than k movies were taken before them."""
    seq = Window.partitionBy("req_id", "movieId").orderBy("pos", "gpos")
    first = cand.withColumn("dup", F.row_number().over(seq)).where("dup = 1")
    per_round = first.groupBy("req_id", "pos").agg(F.count(F.lit(1)).alias("n_round"))
    before = Window.partitionBy("req_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rounds = (per_round.withColumn("taken_before", F.coalesce(F.sum("n_round").over(before), F.lit(0)))
              .where(F.col("taken_before") < k).select("req_id", "pos"))
    return first.join(rounds, ["req_id", "pos"]).select("req_id", "gpos", "pos", "movieId", "score")


def genre_onboarding(requests: DataFrame, movies: DataFrame, ratings: DataFrame, k: int = 10,
                     m: float = 50.0, strict_k: bool = False, exclude: DataFrame | None = None) -> DataFrame:
    """Round-robin over each request's preferred genres (R11 via W6).

    ``requests``: (req_id, genres ARRAY<STRING>) in preference order.  Round r
    takes the r-th movie of every preferred genre in preference order; a movie
    already taken is skipped; a round runs while fewer than k movies were taken
    before it, so the last round may overshoot k (as the reference does).
    Requests without any known genre fall back to the popularity top-k.

    Exactness of the depth bound: the first R positions of one bucket are R
    distinct movies, so after k rounds either k movies are taken or every
    bucket is exhausted; positions beyond k are never needed.  The buckets
    therefore hold n_genres x k rows and the per-request candidates are at most
    k x |genres|.

    ``exclude``: (req_id, movieId) rows never returned; they keep their place in
    the buckets, so a request with s of them in a genre needs k + s positions.
    """
    if exclude is None:
        picked = round_robin_merge(first_places(requests, genre_buckets(movies, ratings, k, m)), k)
    else:
        exclude = written(exclude.select("req_id", "movieId").distinct(), "onboarding-seen")        # read by all jobs below
        pop = written(bayesian_popularity(ratings, m).select("movieId", "score"), "onboarding-popularity")
        places = written(genre_places(movies, ratings, m, pop), "onboarding-places")
        picked = round_robin_merge(open_places(requests, places, exclude, k), k)
    out = top_k_per_group(picked, "req_id", k if strict_k else None, [F.col("pos"), F.col("gpos")])
    out = out.select("req_id", "rank", "movieId", "score")
    missing = requests.select("req_id").join(out.select("req_id").distinct(), "req_id", "left_anti")
    if exclude is not None:
        ranked = global_rank(pop, order_cols(), rank_col="pop_rank")
        asked = missing.select(F.col("req_id").alias("userId"))
        seen = (exclude.join(missing, "req_id", "left_semi").join(ranked.select("movieId", "pop_rank"), "movieId")
                .select(F.col("req_id").alias("userId"), "pop_rank"))
        left = first_k_unseen(seen, asked, k).join(ranked, "pop_rank")
        return out.unionByName(left.select(F.col("userId").alias("req_id"), "rank", "movieId", "score"))
    fb = top_k_global(bayesian_popularity(ratings, m), k, order_cols())
    fallback = missing.crossJoin(F.broadcast(fb.select("rank", "movieId", "score")))
    return out.unionByName(fallback.select("req_id", "rank", "movieId", "score"))


def first_rated_genres(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Onboarding requests derived from the data: each user's stated genres are
    those of the first movie they rated (earliest ts, then lowest movieId)."""
    first = ratings.groupBy("userId").agg(F.min(F.struct("ts", "movieId")).alias("f"))
    return (first.join(movies.select("movieId", "genres"), F.col("f.movieId") == F.col("movieId"))
            .select(F.col("userId").alias("req_id"), genre_array(F.col("genres")).alias("genres")))


def movie_catalog(movies: DataFrame) -> DataFrame:
    """Catalog rows with year and the filterable genre list (no sentinel)."""
    return movies.select("movieId", "title", extract_year(F.col("title")).alias("year"),
                         genre_array(F.col("genres")).alias("genre_list"))


def filter_candidates(candidates: DataFrame, movies: DataFrame, ratings: DataFrame,
                      selected_genres: list[str] | None = None, year_range: tuple[int, int] | None = None,
                      min_quality: float = 0.0, m: float = 50.0) -> DataFrame:
    """Row filters of the dashboard (P15) with its decorations.

    Unknown movie dropped; any-genre overlap; null year passes; Bayesian
    quality >= min_quality, movies without ratings default to the global mean.
    """
    pop = bayesian_popularity(ratings, m).select("movieId", F.col("score").alias("quality"),
                                                 "n_ratings", "mean_rating")
    c = (candidates.join(movie_catalog(movies), "movieId")
         .join(pop, "movieId", "left")
         .crossJoin(F.broadcast(global_mean(ratings)))
         .withColumn("quality", F.coalesce("quality", "C"))
         .withColumn("mean_rating", F.coalesce("mean_rating", "C"))
         .withColumn("n_ratings", F.coalesce("n_ratings", F.lit(0)).cast("bigint")))
    if selected_genres:
        c = c.where(F.arrays_overlap("genre_list", F.array(*[F.lit(g) for g in selected_genres])))
    if year_range is not None:
        c = c.where(F.col("year").isNull() | F.col("year").between(year_range[0], year_range[1]))
    return c.where(F.col("quality") >= F.lit(float(min_quality))).drop("C")


def filter_results(candidates: DataFrame, movies: DataFrame, ratings: DataFrame, limit: int = 10,
                   key: str = "query_id", **filters) -> DataFrame:
    """P15 over ranked candidate lists ``(key, rank, movieId, score)``: first
    ``limit`` survivors of each list in input order."""
    c = filter_candidates(candidates, movies, ratings, **filters)
    c = top_k_per_group(c.withColumnRenamed("rank", "in_rank"), key, limit, [F.col("in_rank")])
    return c.select(key, "rank", "movieId", "title", "year", "score", "quality", "mean_rating", "n_ratings")


def _filtered_global(pop: DataFrame, movies: DataFrame, ratings: DataFrame, limit: int, **filters):
    c = filter_candidates(pop, movies, ratings, **filters)
    top = top_k_global(c, limit, order_cols())
    return top.select("rank", "movieId", "title", "year", "score", "quality", "mean_rating", "n_ratings")


def trending(ratings: DataFrame, movies: DataFrame, limit: int = 10, m: float = 50.0, **filters) -> DataFrame:
    """Top Bayesian-ranked catalog movies through P15 (P16).  The ranking and the
    filters are row-level, so "first `limit` survivors" is a filtered top-k."""
    pop = bayesian_popularity(ratings, m).select("movieId", "score")
    return _filtered_global(pop, movies, ratings, limit, m=m, **filters)


def hidden_gems(ratings: DataFrame, movies: DataFrame, limit: int = 10, m: float = 50.0, **filters) -> DataFrame:
    """``3 <= count <= max(100, int(q35(counts)))`` by score desc, through P15."""
    pop = bayesian_popularity(ratings, m)
    thr = pop.agg(F.greatest(F.lit(100), F.floor(F.percentile("n_ratings", 0.35)).cast("bigint")).alias("thr"))
    gems = (pop.crossJoin(F.broadcast(thr))
            .where((F.col("n_ratings") >= 3) & (F.col("n_ratings") <= F.col("thr")))
            .select("movieId", "score"))
    return _filtered_global(gems, movies, ratings, limit, m=m, **filters)


def popular_seeds(ratings: DataFrame, movies: DataFrame, n: int = 250, m: float = 50.0) -> DataFrame:
    """The n best Bayesian-ranked movies present in the catalog."""
    pop = bayesian_popularity(ratings, m).join(movies.select("movieId", "title"), "movieId", "inner")
    return top_k_global(pop, n, order_cols()).select("rank", "movieId", "title", "score")


def genre_facets(movies: DataFrame) -> DataFrame:
    """Sorted distinct genres (sentinel dropped) with the catalog's year range."""
    g = movies.select(F.explode(genre_array(F.col("genres"))).alias("genre")).distinct()
    yr = movies.agg(F.min(extract_year(F.col("title"))).alias("year_min"),
                    F.max(extract_year(F.col("title"))).alias("year_max"))
    return g.crossJoin(F.broadcast(yr))
