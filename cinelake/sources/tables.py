"""Readers for the base tables and the canonical recommendation inputs.

The driver ships TPC-H-like Parquet tables.  The four canonical inputs of the
engine (``interactions``, ``movies``, ``tags``, ``links``) plus the monitoring
feed are *derived* from them by plain DataFrame expressions, so every query's
work grows with the given tables.  The same derivations exist as SQL CTEs in
``cinelake.plans.views`` for the DuckDB oracle.

CSV readers with explicit schemas cover the MovieLens-style file layout
(``ratings.csv`` / ``movies.csv`` / ``tags.csv`` / ``links.csv``); schemas are
never inferred.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.functions.text import NO_GENRE

RATINGS_SCHEMA = T.StructType([
    T.StructField("userId", T.IntegerType()), T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.FloatType()), T.StructField("timestamp", T.LongType())])
MOVIES_SCHEMA = T.StructType([
    T.StructField("movieId", T.IntegerType()), T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType())])
TAGS_SCHEMA = T.StructType([
    T.StructField("userId", T.IntegerType()), T.StructField("movieId", T.IntegerType()),
    T.StructField("tag", T.StringType()), T.StructField("timestamp", T.LongType())])
LINKS_SCHEMA = T.StructType([
    T.StructField("movieId", T.IntegerType()), T.StructField("imdbId", T.IntegerType()),
    T.StructField("tmdbId", T.DoubleType())])


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- canonical views

def rating_from_quantity(q):
    return F.lit(0.5) + F.lit(0.5) * F.floor((q - F.lit(1.0)) / F.lit(5.0))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(userId, movieId, rating, ts): last line per (customer, part) wins.

    Written as an aggregate, not a window: ``max(struct(ts, qty))`` is a
    two-phase hash aggregate, so duplicates collapse map-side before the
    shuffle on (userId, movieId) instead of sorting every group.
    """
    li = base(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    o = base(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    last = (j.groupBy(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"))
             .agg(F.max(F.struct(F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("q"))).alias("m")))
    return last.select("userId", "movieId", rating_from_quantity(F.col("m.q")).alias("rating"),
                       F.col("m.ts").alias("ts"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(movieId, title, genres) from ``part``: pipe-joined genres, sentinel, optional year."""
    p = base(spark, sf_dir, "part")
    title = (F.when(p.p_partkey % 40 == 7, F.concat(p.p_name, F.lit(" "), p.p_brand))
              .otherwise(F.concat(p.p_name, F.lit(" "), p.p_brand, F.lit(" ("),
                                  (F.lit(1950) + p.p_size).cast("string"), F.lit(")"))))
    genres = (F.when(p.p_partkey % 50 == 0, F.lit(NO_GENRE))
               .otherwise(F.concat_ws("|", p.p_type, F.split_part(p.p_name, F.lit(" "), F.lit(1)),
                                      F.split_part(p.p_name, F.lit(" "), F.lit(2)))))
    return p.select(p.p_partkey.alias("movieId"), title.alias("title"), genres.alias("genres"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(userId, movieId, tag NULL, ts): raw free-text tags, untrimmed and mixed case."""
    li = (base(spark, sf_dir, "lineitem").where(F.col("l_linenumber") == 1)
          .select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate"))
    o = base(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = base(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey"))
    tag = F.when(F.col("l_quantity") == 50, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" "), F.col("c_mktsegment"), F.lit(" ")))
    return j.select(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"),
                    tag.alias("tag"), F.col("l_shipdate").alias("ts"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = base(spark, sf_dir, "part").select("p_partkey")
    return p.select(F.col("p_partkey").alias("movieId"), (F.lit(100000) + F.col("p_partkey")).alias("imdbId"),
                    F.when(F.col("p_partkey") % 100 == 0, F.lit(None).cast("double"))
                     .otherwise((F.col("p_partkey") * 10).cast("double")).alias("tmdbId"))


def rating_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring feed: 'view' events are the baseline, 'purchase' events are live."""
    e = base(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    rating = F.lit(0.5) + F.lit(0.5) * F.floor(F.least(F.col("value"), F.lit(499.0)) / F.lit(50.0))
    return e.select("event_id", "ts", "event_type", rating.alias("rating"), F.col("value").alias("latency_ms"))


# ---------------------------------------------------------------- CSV layout

# Text columns hold doubled quotes, commas and newlines inside quotes; a file
# with newlines in its fields cannot be split, so only those tables pay for it.
CSV_TABLES = {"ratings": (RATINGS_SCHEMA, False), "movies": (MOVIES_SCHEMA, True), "tags": (TAGS_SCHEMA, True), "links": (LINKS_SCHEMA, False)}
_BAD = "_corrupt_record"


def csv_rows(spark: SparkSession, data_dir: str, table: str) -> DataFrame:
    """All records of ``<table>.csv`` (a file or a folder of files) with the
    table's schema; ``_corrupt_record`` holds the text of malformed ones. Quotes
    inside a field are doubled, as the published files have them. Every field is
    parsed, whichever are read: a record is malformed or not for all queries."""
    schema, multi_line = CSV_TABLES[table]
    rows = (spark.read.schema(T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())]))
            .option("header", True).option("escape", '"').option("multiLine", multi_line)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).csv(os.path.join(data_dir, f"{table}.csv")))
    # always true, but it keeps every field in the scan: a field that is pruned is not looked at
    return rows.where(F.xxhash64(*schema.names) >= F.lit(-(1 << 63)))


def load_csv(spark: SparkSession, data_dir: str, table: str) -> DataFrame:
    """The well-formed records; empty strings are nulls."""
    rows = csv_rows(spark, data_dir, table).where(F.col(_BAD).isNull()).drop(_BAD)
    return rows.select(*[F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                         for f in rows.schema.fields])


def quarantined_csv(spark: SparkSession, data_dir: str, table: str) -> DataFrame:
    """(table_name, record): the malformed records that ``load_csv`` leaves out."""
    rows = csv_rows(spark, data_dir, table)
    return rows.where(F.col(_BAD).isNotNull()).select(F.lit(table).alias("table_name"), F.col(_BAD).alias("record"))


def write_csv(df: DataFrame, data_dir: str, table: str, mode: str = "errorifexists") -> None:
    """``df`` as ``<table>.csv`` in the published dialect (doubled quotes)."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(os.path.join(data_dir, f"{table}.csv")))


def load_ratings_csv(spark: SparkSession, data_dir: str) -> DataFrame:
    return load_csv(spark, data_dir, "ratings").withColumn("ts", F.timestamp_seconds("timestamp"))


def load_movies_csv(spark: SparkSession, data_dir: str) -> DataFrame:
    return load_csv(spark, data_dir, "movies")


def load_tags_csv(spark: SparkSession, data_dir: str) -> DataFrame:
    return load_csv(spark, data_dir, "tags").withColumn("ts", F.timestamp_seconds("timestamp"))


def load_links_csv(spark: SparkSession, data_dir: str) -> DataFrame:
    """A missing file is an empty frame with the schema; any other failure is
    raised.  The path is looked up by Spark, so any store it reads will do."""
    from pyspark.errors import AnalysisException
    try:
        return load_csv(spark, data_dir, "links")
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LINKS_SCHEMA)
