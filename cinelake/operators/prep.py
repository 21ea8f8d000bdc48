"""Scans, projections, filters and joins of the preparation layer
(S1-S7, S11-S12, P1-P13, P19-P20, J1-J4, J10, O3-O8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.functions.text import (clean_title, extract_year, genre_array, genre_tokens,
                                     normalise_tag)

HASH_MULT = 2654435761      # Knuth multiplicative hash, 32-bit modulus
HASH_MOD = 4294967296


def epoch_seconds(ts_col: str = "ts"):
    """Seconds since 1970 of a TIMESTAMP_NTZ column, independent of the session time zone."""
    return F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(ts_col))


def hash_key(*cols, seed: int = 42):
    """Reproducible pseudo-random order key in [0, 2^32): identical in every engine
    (plain integer arithmetic, no engine-specific hash)."""
    acc = F.lit(seed).cast("bigint")
    for c in cols:
        acc = F.pmod(F.col(c).cast("bigint") * F.lit(HASH_MULT) + acc, F.lit(HASH_MOD))
    return acc


# ---------------------------------------------------------------- scans

def enrich_movies(movies: DataFrame) -> DataFrame:
    """Movies + year (null when absent) + clean title."""
    return movies.select("movieId", "title", "genres", extract_year(F.col("title")).alias("year"),
                         clean_title(F.col("title")).alias("clean_title"))


def ratings_with_epoch(ratings: DataFrame) -> DataFrame:
    """The ratings table with the epoch-seconds ``timestamp`` column."""
    return ratings.select("userId", "movieId", "rating", epoch_seconds("ts").alias("timestamp"))


def kcore_filter(ratings: DataFrame, min_user: int, min_movie: int) -> DataFrame:
    """Single pass - both counts on the unfiltered table, then both applied
    as semi joins (not iterated to a fixed point, as in the reference)."""
    out = ratings
    if min_user > 0:
        users = ratings.groupBy("userId").count().where(F.col("count") >= min_user).select("userId")
        out = out.join(users, "userId", "left_semi")
    if min_movie > 0:
        mv = ratings.groupBy("movieId").count().where(F.col("count") >= min_movie).select("movieId")
        out = out.join(mv, "movieId", "left_semi")
    return out


def bounded_read(ratings: DataFrame, n: int) -> DataFrame:
    """The first n rows in a defined order (file order is not defined in Spark)."""
    return ratings.orderBy("userId", "movieId", "ts").limit(n)


def fraction_sample(ratings: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Reproducible Bernoulli-style sample: keep a row when its arithmetic
    hash falls below ``fraction`` of the hash range.  Map-only, no shuffle."""
    return ratings.where(hash_key("userId", "movieId", seed=seed) < F.lit(int(fraction * HASH_MOD)))


def baseline_sample(ratings: DataFrame, n: int = 100_000, seed: int = 42) -> DataFrame:
    """At most n ratings without replacement: the n smallest pseudo-random
    hash keys (ties by ids), selected exactly through a key histogram so that
    no single task merges n rows from every partition."""
    from cinelake.functions.ranking import first_n_exact
    h = ratings.withColumn("_h", hash_key("userId", "movieId", seed=seed))
    # bucket = top 20 bits of the 32-bit key: at most 2^20 histogram rows
    out = first_n_exact(h, n, [F.col("_h"), F.col("userId"), F.col("movieId")], F.floor(F.col("_h") / F.lit(4096)))
    return out.drop("_h")


def normalise_tags(tags: DataFrame) -> DataFrame:
    """Drop null tags, lower + trim."""
    return tags.where(F.col("tag").isNotNull()).withColumn("tag_clean", normalise_tag(F.col("tag")))


def tag_frequencies(tags: DataFrame) -> DataFrame:
    return normalise_tags(tags).groupBy("tag_clean").agg(F.count(F.lit(1)).alias("n"))


def frequent_tags(tags: DataFrame, min_tag_freq: int = 2) -> DataFrame:
    """Keep tags whose *global* count >= n (semi join on the tag vocabulary;
    the vocabulary is a small aggregate, AQE broadcasts it when it is small)."""
    t = normalise_tags(tags)
    if min_tag_freq <= 1:
        return t
    keep = tag_frequencies(tags).where(F.col("n") >= min_tag_freq).select("tag_clean")
    return t.join(keep, "tag_clean", "left_semi")


def combine_tags(tags: DataFrame, tag_col: str = "tag_clean") -> DataFrame:
    """One blank-joined string per movie, duplicates kept, ordered by
    (userId, ts, tag).  Aggregated before any join so rows never multiply."""
    g = tags.groupBy("movieId").agg(
        F.array_sort(F.collect_list(F.struct("userId", "ts", F.col(tag_col).alias("t")))).alias("l"))
    return g.select("movieId", F.concat_ws(" ", F.transform("l", lambda x: x["t"])).alias("combined_tags"))


def load_tags(tags: DataFrame, min_tag_freq: int = 2) -> DataFrame:
    """S3: normalise, global-frequency filter, aggregate per movie."""
    return combine_tags(frequent_tags(tags, min_tag_freq))


def content_metadata(movies: DataFrame, tags: DataFrame, min_tag_freq: int = 2) -> DataFrame:
    """Movies left-join pre-aggregated tags + genre tokens + content soup."""
    m = enrich_movies(movies)
    j = m.join(load_tags(tags, min_tag_freq), "movieId", "left").fillna("", subset=["combined_tags"])
    gt = genre_tokens(F.col("genres"))
    soup = F.trim(F.concat_ws(" ", F.col("clean_title"), gt, F.col("combined_tags")))
    return j.select("movieId", "title", "genres", "year", "clean_title", "combined_tags",
                    gt.alias("genre_tokens"), soup.alias("content_soup"))


# ---------------------------------------------------------------- filters / projections

def explode_genres(movies: DataFrame, drop_sentinel: bool = True) -> DataFrame:
    """(movieId, genre) rows; parts stripped, blanks dropped."""
    return movies.select("movieId", F.explode(F.array_distinct(
        genre_array(F.col("genres"), drop_sentinel=drop_sentinel))).alias("genre"))


def binarize(ratings: DataFrame, threshold: float = 4.0) -> DataFrame:
    """P10: label = rating >= threshold."""
    return ratings.select("userId", "movieId", "rating",
                          (F.col("rating") >= F.lit(threshold)).cast("int").alias("label"))


def search_regex(movies: DataFrame, pattern: str, n: int = 10) -> DataFrame:
    """Case-insensitive regex title search, first n by movieId."""
    return (movies.where(F.col("title").rlike("(?i)" + pattern)).orderBy("movieId").limit(n)
            .select("movieId", "title", "genres"))


def search_literal(movies: DataFrame, text: str, n: int = 250) -> DataFrame:
    """Case-insensitive literal title search, first n by movieId."""
    return (movies.where(F.contains(F.lower(F.col("title")), F.lower(F.lit(text))))
            .orderBy("movieId").limit(n).select("movieId", "title", "genres"))


def invalid_values(ratings: DataFrame) -> DataFrame:
    """NaN / infinite / off-scale ratings, one scan."""
    r = F.col("rating")
    return ratings.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.isnan(r)).alias("n_nan"),
        F.count_if(r.isin(float("inf"), float("-inf"))).alias("n_inf"),
        F.count_if(~F.isnan(r) & ((r < 0.5) | (r > 5.0))).alias("n_out_of_range"),
        F.count_if(~F.isnan(r) & (F.pmod(r * 2, F.lit(1.0)) != 0)).alias("n_off_step"),
        F.count_if(r.isNull()).alias("n_null"))


def decorate(results: DataFrame, movies: DataFrame) -> DataFrame:
    """Attach title and genres to ranked ids; missing -> 'Unknown' / ''."""
    return (results.join(movies.select("movieId", "title", "genres"), "movieId", "left")
            .withColumn("title", F.coalesce("title", F.lit("Unknown")))
            .withColumn("genres", F.coalesce("genres", F.lit(""))))


def user_sequence(ratings: DataFrame) -> DataFrame:
    """O3: ratings in (userId, ts) order with their position in the user's
    history (a range-partitioned rank: a heavy user spans many tasks)."""
    from cinelake.functions.ranking import rank_within
    r = rank_within(ratings.select("userId", "movieId", "rating", "ts"), "userId",
                    [F.col("ts").asc(), F.col("movieId").asc()], out="seq")
    return r.select("userId", "movieId", "rating", "seq")
