"""Streaming monitors that keep what has been seen so far (T2, T3), with
arbitrary state per key instead of event-time windows.

``latency_buffer_stream``: the newest records, in buffers spread over shards by
record; every shard keeps its own newest ``size``, so the newest of all are among
them whatever the order of arrival. A shard that met new records emits its buffer
as one row; ``merged_buffer`` takes every shard's last one.

``cumulative_drift_stream``: the histogram of all live values so far, compared
with a fixed baseline; one row per micro-batch. Tasks count the values of their
own rows first, so the one key meets tasks x distinct values rows, and the state
has one count per distinct value (ratings lie on a grid).

Both are append-only streams into Parquet, restartable from their checkpoint.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cinelake.session import ensure_checkpoint_dir

BUFFER = 10_000
SHARDS = 8
_NO_TIME = -(1 << 63)
_RECORDS = "ts array<bigint>, event_id array<bigint>, latency array<double>"


def _keep_newest(size: int):
    def run(key, frames, state: GroupState):
        ts, ids, lat = (list(x) for x in state.get) if state.exists else ([], [], [])
        stamp = None
        for f in frames:
            stamp = f["batch"].iloc[0]
            ts += f["micros"].tolist()
            ids += f["event_id"].tolist()
            lat += [None if pd.isna(x) else float(x) for x in f["latency_ms"]]
            if len(ts) > 2 * size:
                ts, ids, lat = _newest(ts, ids, lat, size)
        ts, ids, lat = _newest(ts, ids, lat, size)
        state.update((ts, ids, lat))
        yield pd.DataFrame({"batch": [stamp], "shard": [key[0]], "ts": [ts], "event_id": [ids], "latency": [lat]})
    return run


def _newest(ts: list, ids: list, lat: list, size: int) -> tuple[list, list, list]:
    order = np.lexsort((-np.array(ids, np.int64), -np.maximum(np.array(ts, np.int64), _NO_TIME + 1)))[:size]
    return [ts[i] for i in order], [ids[i] for i in order], [lat[i] for i in order]


def latency_buffer_stream(feed: DataFrame, size: int = BUFFER, shards: int = SHARDS) -> DataFrame:
    """(batch, shard, ts, event_id, latency): the shard's newest ``size``
    records (by ts, then event_id) after each micro-batch that touched it."""
    rows = feed.select(F.unix_micros(F.current_timestamp()).alias("batch"), F.pmod(F.xxhash64("event_id"), F.lit(shards)).cast("int").alias("shard"),
                       F.coalesce(F.unix_micros("ts"), F.lit(_NO_TIME)).alias("micros"), "event_id", "latency_ms")
    return rows.groupBy("shard").applyInPandasWithState(
        _keep_newest(size), f"batch bigint, shard int, {_RECORDS}", _RECORDS, "append", GroupStateTimeout.NoTimeout)


def merged_buffer(emitted: DataFrame, size: int = BUFFER) -> DataFrame:
    """event_id, ts, latency_ms: the newest ``size`` records of all shards."""
    from cinelake.functions.ranking import first_n_exact
    last = emitted.groupBy("shard").agg(F.max_by(F.struct("ts", "event_id", "latency"), "batch").alias("b"))
    rows = last.select(F.explode(F.arrays_zip("b.ts", "b.event_id", "b.latency")).alias("r")).select(
        F.col("r.event_id").alias("event_id"), F.when(F.col("r.ts") > _NO_TIME, F.timestamp_micros("r.ts")).alias("ts"), F.col("r.latency").alias("latency_ms"))
    hour = -F.floor(F.unix_seconds("ts") / F.lit(3600))
    return first_n_exact(rows, size, [F.col("ts").desc(), F.col("event_id").desc()], hour)


def _count_values(batches):
    """Rows (batch, x, n) with the counts of each distinct value of a task."""
    for batch in batches:
        found = pa.TableGroupBy(pa.Table.from_batches([batch]), ["batch", "x"]).aggregate([([], "count_all")])
        yield from found.select(["batch", "x", "count_all"]).rename_columns(["batch", "x", "n"]).to_batches()


def _ks_against(base_x: np.ndarray, base_n: np.ndarray):
    def run(key, frames, state: GroupState):
        x, n = (np.array(v) for v in state.get) if state.exists else (np.zeros(0), np.zeros(0, np.int64))
        stamp = 0
        for f in frames:
            stamp = int(f["batch"].iloc[0])
            x, at = np.unique(np.concatenate([x, f["x"].to_numpy(np.float64)]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n, f["n"].to_numpy(np.int64)]), len(x)).astype(np.int64)
        state.update((x.tolist(), n.tolist()))
        grid = np.union1d(base_x, x)
        share = lambda v, c: np.concatenate([[0], np.cumsum(c)])[np.searchsorted(v, grid, "right")] / max(int(c.sum()), 1)
        d = float(np.abs(share(base_x, base_n) - share(x, n)).max()) if len(grid) else 0.0
        yield pd.DataFrame({"batch": [stamp], "n_base": [int(base_n.sum())], "n_live": [int(n.sum())], "D": [d]})
    return run


def cumulative_drift_stream(live: DataFrame, baseline: DataFrame, value: str = "rating") -> DataFrame:
    """(batch, n_base, n_live, D) of all ``live`` values up to and with each
    micro-batch against the static ``baseline``. Null values do not count."""
    hist = baseline.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x")).agg(
        F.count(F.lit(1)).alias("n")).orderBy("x").toPandas()               # one row per rating value
    rows = live.where(F.col(value).isNotNull()).select(F.unix_micros(F.current_timestamp()).alias("batch"), F.col(value).cast("double").alias("x"))
    counted = rows.mapInArrow(_count_values, "batch bigint, x double, n bigint")
    return counted.withColumn("one", F.lit(0)).groupBy("one").applyInPandasWithState(
        _ks_against(hist["x"].to_numpy(np.float64), hist["n"].to_numpy(np.int64)), "batch bigint, n_base bigint, n_live bigint, D double",
        "x array<double>, n array<bigint>", "append", GroupStateTimeout.NoTimeout)


def run_in_slices(spark: SparkSession, rows: DataFrame, slices: list, build, name: str) -> DataFrame:
    """Feed ``rows`` to a stream slice by slice (``slices``: conditions): each
    slice lands as new files of one folder and the stream of ``build(files)`` is
    started again from its checkpoint to take them in as one micro-batch.
    Returns the sink."""
    root = ensure_checkpoint_dir(spark).rstrip("/") + f"/streams/{name}-{uuid.uuid4().hex[:8]}"
    for i, condition in enumerate(slices):
        rows.where(condition).write.mode("append").parquet(root + "/feed")
        stream = build(spark.readStream.schema(rows.schema).parquet(root + "/feed"))
        q = (stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", root + "/_checkpoint")
             .option("path", root + "/data").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(root + "/data")
