"""Ranking helpers shared by every top-k operator.

Total order everywhere: the score descending, then the id ascending, so the
result never depends on partitioning or sort stability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_cols(score: str = "score", key: str = "movieId") -> list[Column]:
    return [F.col(score).desc(), F.col(key).asc()]


def top_k_per_group(df: DataFrame, group: list[str] | str, k: int | Column | None,
                    order: list[Column], rank_col: str = "rank") -> DataFrame:
    """``row_number() <= k`` per group.  With a literal k Spark plans a
    ``WindowGroupLimit`` that trims every group map-side before the shuffle
    sort, so a heavy group costs O(k) memory per partition, not O(group)."""
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn(rank_col, F.row_number().over(w))
    if k is None:
        return out
    kk = F.lit(k) if isinstance(k, int) else k
    return out.where(F.col(rank_col) <= kk)


def top_k_global(df: DataFrame, k: int, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """Global top-k: ``orderBy().limit(k)`` (TakeOrderedAndProject: k rows per
    partition reach the driver), then numbering over the k survivors only."""
    top = df.orderBy(*order).limit(k)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """Dense 1..n row numbers over the whole frame without a single-partition
    window: range-partition on the order, number rows inside each range, add
    the row count of all earlier ranges (one small row per range).

    Range bounds come from sampling, so both passes (local numbering and range
    sizes) must read one materialisation: it is written once with a reliable
    ``checkpoint`` (shared checkpoint folder, survives executor loss).
    """
    from cinelake.session import ensure_checkpoint_dir
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(df.sparkSession)
    s = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    local = s.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    local = local.checkpoint(eager=True)
    counts = local.groupBy("_pid").agg(F.max("_rn").alias("_n"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (local.join(F.broadcast(offs.select("_pid", "_off")), "_pid")
            .withColumn(rank_col, F.col("_off") + F.col("_rn"))
            .drop("_pid", "_rn", "_off"))


def first_k_unseen(seen_ranks: DataFrame, users: DataFrame, k: int, rank_col: str = "pop_rank") -> DataFrame:
    """Per user, the k smallest global ranks that the user has not seen.

    ``seen_ranks``: (userId, <rank_col>) of seen items.  The unseen ranks lie in
    the gaps between consecutive seen ranks; a gap is kept only while fewer than
    k unseen ranks precede it, and is expanded with ``sequence`` to at most the
    ranks still missing, so the output is exactly users x k rows and no
    user x catalog product is formed.  Per-user work is bounded by the user's
    de-duplicated history, which is bounded by the catalog size.
    """
    # j = position of the seen rank in the user's history, prev = the seen rank
    # before it: range-partitioned, so a long history is not one task's sort
    s = lag_within(seen_ranks.select("userId", rank_col), "userId", [F.col(rank_col).asc()], rank_col,
                   out="prev", rank_out="j").withColumn("prev", F.coalesce(F.col("prev"), F.lit(0)))
    # gap before each seen rank: ranks prev+1 .. r-1, unseen before it = prev - (j-1)
    gaps = s.select("userId", (F.col("prev") + 1).alias("g_start"), (F.col(rank_col) - 1).alias("g_end"),
                    (F.col("prev") - (F.col("j") - 1)).alias("before"))
    last = s.groupBy("userId").agg(F.max(rank_col).alias("r"), F.count(F.lit(1)).alias("m"))
    tail = last.select("userId", (F.col("r") + 1).alias("g_start"), F.lit(None).cast("bigint").alias("g_end"),
                       (F.col("r") - F.col("m")).alias("before"))
    fresh = users.select("userId").join(last.select("userId"), "userId", "left_anti").select(
        "userId", F.lit(1).cast("bigint").alias("g_start"), F.lit(None).cast("bigint").alias("g_end"),
        F.lit(0).cast("bigint").alias("before"))
    allg = gaps.unionByName(tail).unionByName(fresh).where(F.col("before") < k)
    need = F.lit(k) - F.col("before")
    stop = F.when(F.col("g_end").isNull(), F.col("g_start") + need - 1).otherwise(
        F.least(F.col("g_end"), F.col("g_start") + need - 1))
    allg = allg.where(stop >= F.col("g_start"))
    out = allg.select("userId", "before", "g_start", F.explode(F.sequence(F.col("g_start"), stop)).alias(rank_col))
    return out.select("userId", rank_col, (F.col("before") + F.col(rank_col) - F.col("g_start") + 1).alias("rank"))


def global_running_sums(df: DataFrame, order: list[Column], cols: list[str], prefix: str = "cum_",
                        partitions: int | None = None, range_col: str | None = None) -> DataFrame:
    """Running sums of ``cols`` over the whole frame in ``order`` (rows up to and
    including the current one), computed like ``global_rank``: per range a
    local running sum, plus the totals of all earlier ranges.  ``range_col``
    keeps the number of the range under that name."""
    from cinelake.session import ensure_checkpoint_dir
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(df.sparkSession)
    s = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = s.select("*", *[F.sum(c).over(w).alias(f"_l_{c}") for c in cols]).checkpoint(eager=True)
    tot = local.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    prev = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    offs = tot.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(prev), F.lit(0)).alias(f"_o_{c}") for c in cols])
    out = local.join(F.broadcast(offs), "_pid")
    for c in cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_o_{c}") + F.col(f"_l_{c}"))
    if range_col:
        out = out.withColumn(range_col, F.col("_pid"))
    return out.drop("_pid", *[f"_l_{c}" for c in cols], *[f"_o_{c}" for c in cols])


def first_n_exact(df: DataFrame, n: int, order: list[Column], bucket: Column) -> DataFrame:
    """``ORDER BY <order> LIMIT n`` for a large n without a final merge task of
    partitions x n rows (what ``TakeOrderedAndProject`` does).

    ``bucket`` is a coarse prefix of the order (non-decreasing along it, e.g.
    the top bits of a hash key or the hour of a timestamp).  A count histogram
    over the buckets (partial aggregation; its size is fixed by the bucket
    expression, not by the data) and a running count give the bucket in which
    the n-th row falls; only that one (bucket, rows before it) pair reaches the
    driver.  Rows of earlier buckets are kept by a plain filter, and the sorted
    limit runs over the boundary bucket alone for the remaining rows.  The
    result is the same row set as the sort + limit; rows without a bucket come
    last.
    """
    bucket = F.coalesce(bucket.cast("bigint"), F.lit((1 << 63) - 1))
    hist = df.select(bucket.alias("_b")).groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    cum = global_running_sums(hist, [F.col("_b").asc()], ["_c"])
    hit = cum.where(F.col("cum__c") >= F.lit(n)).orderBy("_b").limit(1).select(
        "_b", (F.col("cum__c") - F.col("_c")).alias("_before")).first()
    if hit is None:                          # fewer than n rows in total
        return df
    b_star, before = hit["_b"], int(hit["_before"])
    full = df.where(bucket < F.lit(b_star))
    edge = df.where(bucket == F.lit(b_star)).orderBy(*order).limit(n - before)
    return full.unionByName(edge)


def lag_within(df: DataFrame, key: str, order: list[Column], value: str, out: str = "prev",
               partitions: int | None = None, rank_out: str | None = None) -> DataFrame:
    """``lag(value) OVER (PARTITION BY key ORDER BY order)`` (and, with
    ``rank_out``, the row number in the same order) without sending a whole
    key group to one task.

    Rows are range-partitioned on (key, order), so a key holding a third of
    the rows spans many ranges.  Inside a range the lag is a local window; the
    first row of a range takes the value of the last row of the nearest earlier
    non-empty range when that row has the same key (a table of one row per
    range, broadcast).  The rank adds the key's row count in earlier ranges
    (one row per (range, key)).  Range bounds come from sampling, so the local
    pass is written once with a reliable ``checkpoint`` and every read sees
    the same ranges.
    """
    from cinelake.session import ensure_checkpoint_dir
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(df.sparkSession)
    s = df.repartitionByRange(n, F.col(key), *order).withColumn("_pid", F.spark_partition_id())
    in_range = Window.partitionBy("_pid").orderBy(F.col(key), *order)
    in_key = Window.partitionBy("_pid", key).orderBy(*order)
    local = (s.withColumn(out, F.lag(value).over(in_key))
             .withColumn("_lr", F.row_number().over(in_key))
             .withColumn("_rn", F.row_number().over(in_range))
             .withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy("_pid")))
             .checkpoint(eager=True))
    last = local.where(F.col("_rn") == F.col("_cnt")).select("_pid", F.col(key).alias("_lk"),
                                                              F.col(value).alias("_lv"))
    prev = Window.orderBy("_pid")                              # one row per range
    carry = last.select("_pid", F.lag("_lk").over(prev).alias("_pk"), F.lag("_lv").over(prev).alias("_pv"))
    j = local.join(F.broadcast(carry), "_pid", "left")
    fix = (F.col("_rn") == 1) & (F.col("_pk") == F.col(key))
    j = j.withColumn(out, F.when(fix, F.col("_pv")).otherwise(F.col(out)))
    if rank_out is not None:
        cnt = local.groupBy("_pid", key).agg(F.count(F.lit(1)).alias("_c"))
        before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        off = cnt.select("_pid", key, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
        j = j.join(off, ["_pid", key]).withColumn(rank_out, F.col("_off") + F.col("_lr")).drop("_off")
    return j.drop("_pid", "_rn", "_lr", "_cnt", "_pk", "_pv")


def rank_within(df: DataFrame, key: str, order: list[Column], out: str = "rn",
                partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY key ORDER BY order)`` without sending a
    whole key group to one task: range-partition on (key, order), number rows
    per (range, key), and add the row count of the same key in earlier ranges
    (a table of one row per (range, key); a key spans at most all ranges, so
    its offset window is bounded by the range count).  The local pass is
    checkpointed: range bounds come from sampling and are read twice."""
    from cinelake.session import ensure_checkpoint_dir
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(df.sparkSession)
    s = df.repartitionByRange(n, F.col(key), *order).withColumn("_pid", F.spark_partition_id())
    local = s.withColumn("_lr", F.row_number().over(Window.partitionBy("_pid", key).orderBy(*order))) \
        .checkpoint(eager=True)
    cnt = local.groupBy("_pid", key).agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = cnt.select("_pid", key, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    return (local.join(off, ["_pid", key]).withColumn(out, F.col("_off") + F.col("_lr"))
            .drop("_pid", "_lr", "_off"))
