"""Helpers shared by the training-data operators: table access, row keys,
size-checked broadcast and scratch tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.session import ensure_checkpoint_dir

# A table is broadcast only after it has been written and counted and has at
# most this many (narrow) rows; beyond it the same join is left to a shuffle.
BROADCAST_ROWS = 100_000

# The vocabulary files of the registered queries; operators take a path.
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later jobs and
    lost executors reread files instead of repeating the work."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row_key(df: DataFrame, *cols: str) -> DataFrame:
    """``k1, k2``: a 128-bit key of the given columns. Rows that agree in all of
    them share a key, whatever other columns they have; nulls are values."""
    full = [c for x in cols for c in (F.col(x).isNull(), F.col(x))]
    return df.withColumns({"k1": F.xxhash64(F.lit("k1"), *full), "k2": F.xxhash64(F.lit("k2"), *reversed(full))})


def if_small(df: DataFrame, name: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Write ``df`` and mark it for broadcast only if its counted rows are few."""
    out = written(df, name)
    return F.broadcast(out) if out.count() <= max_rows else out


def mixed_partitions(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
