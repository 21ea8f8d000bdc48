"""Structured Streaming monitors.

The feed is read as a file stream (schema given, never inferred), event time
is the ``ts`` column cast to TIMESTAMP (watermarks need a zoned timestamp),
late rows beyond a 1-hour watermark are dropped, and windowed aggregates are
the only state.  ``run_windows`` returns every window, closed or still open.  ``run_to_table`` drives a query to completion with
``availableNow`` into a Parquet sink under the shared checkpoint folder and
returns the sink as a batch DataFrame, which is how tests compare a stream
with its batch twin in ``cinelake.operators.monitor``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.session import ensure_checkpoint_dir

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
WATERMARK = "1 hour"


def feed_stream(spark: SparkSession, events_dir: str, file_glob: str = "events*.parquet",
                max_files: int = 1) -> DataFrame:
    """Streaming rating/latency feed from the event files of a folder (same
    derivation as the batch view); new files arriving there are new input."""
    e = (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files)
         .option("pathGlobFilter", file_glob).parquet(events_dir))
    rating = F.lit(0.5) + F.lit(0.5) * F.floor(F.least(F.col("value"), F.lit(499.0)) / F.lit(50.0))
    # NTZ -> instant read as UTC, independent of the session time zone
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts"))
    return e.select("event_id", F.timestamp_micros(micros).alias("ts"), "event_type", rating.alias("rating"),
                    F.col("value").alias("latency_ms"))


def rating_histogram_stream(feed: DataFrame, window: str = "1 day", slide: str | None = None) -> DataFrame:
    """T2 state: per event-time window and feed part, counts per rating value.
    The KS statistic of a finished window against the baseline histogram is a
    batch computation on the emitted rows (see ``ks_from_histograms``)."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    return (feed.withWatermark("ts", WATERMARK)
            .groupBy(w.alias("w"), "event_type", "rating").agg(F.count(F.lit(1)).alias("n"))
            .select(F.unix_seconds(F.col("w.start")).alias("window_start"), F.unix_seconds(F.col("w.end")).alias("window_end"),
                    "event_type", "rating", "n"))


def latency_histogram_stream(feed: DataFrame, window: str = "6 hours") -> DataFrame:
    """T3 state: per tumbling event-time window, the count of every latency
    value.  The state is keyed by (window, value), so it is hash-spread over
    the state-store partitions instead of one exact-percentile buffer per
    window; percentiles of the closed windows are computed from the emitted
    counts (``latency_from_histogram``)."""
    return (feed.withWatermark("ts", WATERMARK).groupBy(F.window("ts", window).alias("w"), "latency_ms")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.unix_seconds(F.col("w.start")).alias("window_start"), F.unix_seconds(F.col("w.end")).alias("window_end"), "latency_ms", "n"))


def latency_mean_stream(feed: DataFrame, window: str = "6 hours") -> DataFrame:
    """T3 companion: mean latency and record count per window (two numbers of
    state per window)."""
    return (feed.withWatermark("ts", WATERMARK).groupBy(F.window("ts", window).alias("w"))
            .agg(F.avg("latency_ms").alias("mean"), F.count(F.lit(1)).alias("n"))
            .select(F.unix_seconds(F.col("w.start")).alias("window_start"), F.unix_seconds(F.col("w.end")).alias("window_end"), "mean", "n"))


def run_windows(feed: DataFrame, aggregate, name: str) -> DataFrame:
    """Run a windowed aggregate of a streaming ``feed`` to completion: windows
    that the watermark closes are emitted by the stream (append mode); the rows
    of the feed land too, and the windows still open at the end are aggregated
    from them by a batch pass. One rule holds for every row: it counts unless
    its window had closed when it came. A window that the last watermark has
    closed without an emission had late rows only, and is left out."""
    closed = run_to_table(aggregate(feed), name)
    landed = run_to_table(feed, name + "-feed")
    newest = landed.agg(F.unix_micros(F.max("ts")).alias("m")).first()["m"]
    watermark = (newest or 0) - 3_600_000_000                     # WATERMARK behind the newest event
    open_ones = aggregate(landed).where(F.col("window_end") * 1_000_000 > F.lit(watermark))
    open_ones = open_ones.join(closed.select("window_start").distinct(), "window_start", "left_anti")
    return closed.unionByName(open_ones).drop("window_end")


def run_to_table(query_df: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    """Run a streaming frame to completion (availableNow) into Parquet under the
    session's checkpoint folder; return the sink as a batch frame."""
    spark = query_df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/") + f"/streams/{name}-{uuid.uuid4().hex[:8]}"
    q = (query_df.writeStream.outputMode(output_mode).format("parquet")
         .option("checkpointLocation", root + "/_checkpoint").option("path", root + "/data")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(root + "/data")


def ks_from_histograms(hist: DataFrame, base_type: str = "view", live_type: str = "purchase") -> DataFrame:
    """KS statistic per window from the streamed histograms: the baseline is
    every window's ``base_type`` counts summed, the live side one window's
    ``live_type`` counts."""
    from cinelake.operators.monitor import ks_from_counts
    base = (hist.where(F.col("event_type") == base_type).groupBy("rating").agg(F.sum("n").alias("cb")))
    live = hist.where(F.col("event_type") == live_type).select("window_start", "rating", F.col("n").alias("cl"))
    return ks_from_counts(base.withColumnRenamed("rating", "x"), live.withColumnRenamed("rating", "x"), "window_start")


def rating_event_stream(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    """Live rating events from the line-item files of a folder: one rating per
    line (no de-duplication: a feed, not the catalog), event time = the day the
    line ships, as a UTC instant."""
    from cinelake.sources.tables import rating_from_quantity
    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema     # footer only
    e = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
         .option("pathGlobFilter", "lineitem*.parquet").parquet(sf_dir))
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("l_shipdate"))
    ets = F.timestamp_micros(micros)
    return e.select(F.col("l_partkey").alias("movieId"), rating_from_quantity(F.col("l_quantity")).alias("rating"),
                    ets.alias("ts"))


def movie_popularity_stream(events: DataFrame, window: str = "1 day") -> DataFrame:
    """T5 state: per event-time window and movie, rating count and sum (two
    sums per key; partial aggregation runs before the state store shuffle)."""
    return (events.withWatermark("ts", WATERMARK)
            .groupBy(F.window("ts", window).alias("w"), "movieId")
            .agg(F.count(F.lit(1)).alias("v"), F.sum("rating").alias("s"))
            .select(F.unix_seconds(F.col("w.start")).alias("window_start"), F.unix_seconds(F.col("w.end")).alias("window_end"), "movieId", "v", "s"))


def window_popularity(counts: DataFrame, baseline: DataFrame, m: float = 50.0, k: int = 10) -> DataFrame:
    """Bayesian score of every movie in each closed window (C = the window's
    mean rating), the window's top k, and each one's all-time ``base_rank``
    (null when outside the baseline top k)."""
    from cinelake.functions.ranking import top_k_global, top_k_per_group
    c = counts.groupBy("window_start").agg((F.sum("s") / F.sum("v")).alias("C"))
    mm = F.lit(float(m))
    sc = counts.join(c, "window_start").select(
        "window_start", "movieId", "v",
        (F.col("v") / (F.col("v") + mm) * (F.col("s") / F.col("v")) + mm / (F.col("v") + mm) * F.col("C"))
        .alias("score"))
    top = top_k_per_group(sc, "window_start", k, [F.col("score").desc(), F.col("movieId").asc()],
                          rank_col="window_rank")
    base_top = top_k_global(baseline, k, [F.col("score").desc(), F.col("movieId").asc()], rank_col="base_rank")
    return top.join(base_top.select("movieId", "base_rank"), "movieId", "left").select(
        "window_start", "window_rank", "movieId", "v", "score", "base_rank")
