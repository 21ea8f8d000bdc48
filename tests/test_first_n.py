"""``first_n_exact`` returns the same rows as ``orderBy(...).limit(n)``, also
when one bucket holds most rows, when the n-th row sits on a bucket edge, and
when n exceeds the row count."""

import pytest
from pyspark.sql import functions as F

from cinelake.functions.ranking import first_n_exact


@pytest.fixture(scope="module")
def skewed(spark):
    # 3,000 rows; bucket 7 alone holds 2,000 of them, with many tied keys
    rows = [(i, 7 * 100 + (i % 13), i % 5) for i in range(2000)]
    rows += [(2000 + i, (i * 37) % 1000, i % 3) for i in range(1000)]
    return spark.createDataFrame(rows, "id long, key long, grp long")


@pytest.mark.parametrize("n", [1, 150, 699, 700, 701, 2500, 3000, 5000])
def test_matches_sort_limit(skewed, n):
    order = [F.col("key").asc(), F.col("id").asc()]
    bucket = F.floor(F.col("key") / F.lit(100))
    got = sorted(tuple(r) for r in first_n_exact(skewed, n, order, bucket).collect())
    want = sorted(tuple(r) for r in skewed.orderBy(*order).limit(n).collect())
    assert got == want


def test_descending_bucket(skewed):
    order = [F.col("key").desc(), F.col("id").desc()]
    bucket = -F.floor(F.col("key") / F.lit(100))
    got = sorted(tuple(r) for r in first_n_exact(skewed, 1234, order, bucket).collect())
    want = sorted(tuple(r) for r in skewed.orderBy(*order).limit(1234).collect())
    assert got == want


def test_lag_within_matches_window(spark):
    """The range-partitioned lag equals the plain window lag, also for a key
    that spans many ranges."""
    from pyspark.sql import Window

    from cinelake.functions.ranking import lag_within
    rows = [(1, i, f"a{i}") for i in range(3000)] + [(k, i, f"b{k}_{i}") for k in range(2, 40) for i in range(7)]
    df = spark.createDataFrame(rows, "k long, o long, v string")
    got = {(r["k"], r["o"]): r["prev"] for r in lag_within(df, "k", [F.col("o")], "v", partitions=16).collect()}
    w = Window.partitionBy("k").orderBy("o")
    want = {(r["k"], r["o"]): r["prev"] for r in df.withColumn("prev", F.lag("v").over(w)).collect()}
    assert got == want


def test_rank_within_matches_row_number(spark):
    """The range-partitioned rank equals row_number per key, with one key
    spanning many ranges and a descending order."""
    from pyspark.sql import Window

    from cinelake.functions.ranking import rank_within
    rows = [(1, i % 97, i) for i in range(3000)] + [(k, i, i) for k in range(2, 50) for i in range(5)]
    df = spark.createDataFrame(rows, "k long, o long, t long")
    order = [F.col("o").desc(), F.col("t").asc()]
    got = {(r["k"], r["t"]): r["rn"] for r in rank_within(df, "k", order, partitions=16).collect()}
    w = Window.partitionBy("k").orderBy(*order)
    want = {(r["k"], r["t"]): r["rn"] for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want


def test_lag_within_rank_out(spark):
    from pyspark.sql import Window

    from cinelake.functions.ranking import lag_within
    rows = [(1, i, i * 3) for i in range(2500)] + [(k, i, i) for k in range(2, 30) for i in range(4)]
    df = spark.createDataFrame(rows, "k long, o long, v long")
    out = lag_within(df, "k", [F.col("o")], "v", out="prev", rank_out="j", partitions=16)
    got = {(r["k"], r["o"]): (r["prev"], r["j"]) for r in out.collect()}
    w = Window.partitionBy("k").orderBy("o")
    want = {(r["k"], r["o"]): (r["prev"], r["j"])
            for r in df.select("k", "o", F.lag("v").over(w).alias("prev"), F.row_number().over(w).alias("j"))
            .collect()}
    assert got == want
