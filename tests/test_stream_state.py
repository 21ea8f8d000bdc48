"""Streams with state over all that was seen: order of arrival, restarts, batch twins."""

import random

import pytest
from pyspark.sql import functions as F

from cinelake.operators import monitor as T
from cinelake.streaming import buffers as B


def feed(spark, rows):
    return spark.createDataFrame(rows, "event_id long, micros long, latency_ms double").select(
        "event_id", F.timestamp_micros("micros").alias("ts"), "latency_ms")


def newest(rows, n):
    return sorted(((r[0], r[2]) for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]), reverse=True)[:n]))


def test_buffer_of_any_order_of_arrival(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(0, 10**12) if i % 50 else None, rng.random() if i % 7 else None) for i in range(600)]
    rows += [(1000 + i, 5 * 10**11, 1.0) for i in range(30)]                          # equal times
    df = feed(spark, rows)
    for seed in (0, 1):
        order = F.pmod(F.xxhash64("event_id", F.lit(seed)), F.lit(3))
        out = B.run_in_slices(spark, df, [order == i for i in (2, 0, 1)], lambda s: B.latency_buffer_stream(s, size=100, shards=4), "test-buffer")
        assert out.groupBy("shard").count().count() <= 4 and out.agg(F.max(F.size("ts"))).first()[0] == 100
        got = B.merged_buffer(out, 100)
        assert sorted((r.event_id, r.latency_ms) for r in got.collect()) == newest(rows, 100)
        batch = T.latency_summary(T.latency_last_n(df.withColumn("ts", F.col("ts").cast("timestamp_ntz")), 100)).first()
        assert list(T.latency_summary(got).first()) == pytest.approx(list(batch), abs=1e-12)


def test_cumulative_drift_equals_batch(spark):
    rng = random.Random(3)
    base = spark.createDataFrame([(rng.randrange(1, 11) / 2,) for _ in range(400)] + [(None,)], "rating double")
    live = [(i, rng.randrange(4, 11) / 2 if i % 9 else None, 0 if i < 2 else 1 if i < 4 else 2 if i < 60 else 3) for i in range(1, 300)]
    df = spark.createDataFrame(live, "event_id long, rating double, slice int")
    out = B.run_in_slices(spark, df, [F.col("slice") == i for i in range(4)],
                          lambda s: B.cumulative_drift_stream(s, base), "test-drift").orderBy("batch").collect()
    assert len(out) == 4
    for i, row in enumerate(out):
        seen = df.where((F.col("slice") <= i) & F.col("rating").isNotNull()).select("rating")
        want = T.ks_drift(base.where("rating is not null"), seen).first()
        report = T.ks_report(spark.createDataFrame([row])).first()
        assert (report.status, report.sample_size) == (want.status, want.sample_size)
        assert abs(report.ks_statistic - want.ks_statistic) < 1e-12 and abs(report.p_value - want.p_value) < 1e-12
    assert [r.status for r in T.ks_report(spark.createDataFrame(out)).collect()].count("INSUFFICIENT_DATA") == 1


def test_late_rows_of_closed_windows_do_not_count(spark, tmp_path):
    """Whether or not the stream ever emitted the window that they belong to."""
    from cinelake.streaming import drift as D
    hour = 3600
    batches = [[(1, 10 * hour, 1.0), (2, 10 * hour + 5, 1.0)], [(3, 40 * hour, 2.0)], [(8, 41 * hour, 2.0)],
               [(4, 10 * hour + 9, 9.0), (5, 3 * hour, 9.0), (6, 40 * hour + 1, 2.0), (7, 39 * hour + 1900, 3.0)]]
    for i, rows in enumerate(batches):
        (spark.createDataFrame(rows, "event_id long, s long, latency_ms double").select("event_id", F.timestamp_seconds("s").alias("ts"), "latency_ms")
         .coalesce(1).write.mode("append").parquet(str(tmp_path / "feed")))
    feed = (spark.readStream.schema("event_id long, ts timestamp, latency_ms double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed")))
    got = D.run_windows(feed, D.latency_histogram_stream, "late")
    assert sorted((r.window_start // hour, r.latency_ms, r.n) for r in got.collect()) == [(6, 1.0, 2), (36, 2.0, 3), (36, 3.0, 1)]
