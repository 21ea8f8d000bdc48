"""Exact percentiles without holding a group's distinct values in one task.

Spark's exact ``percentile`` aggregate keeps a map of every distinct value of
a group and merges the maps in one final task, so a continuous column (a
latency, a timestamp) over a hot group costs memory in proportion to the
data.  Here the work is a value histogram instead:

1. ``(group, value) -> n`` counts, partially aggregated before the shuffle
   (a value repeated a million times is one row);
2. a running count over (group, value) computed range-partitioned
   (``global_running_sums``), so one large group is split over many tasks;
3. per group the two ranks around ``p * (N - 1)`` are assigned to the range of
   the running count that holds them (the ends of the ranges, one number each,
   are known), located there by an equi join on range and group and a rank
   filter, so that a task meets the rows of one range at most, and
   interpolated linearly: the definition of Spark's ``percentile`` and of
   DuckDB's ``quantile_cont``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.ranking import global_running_sums


def value_counts(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    """(group..., value, n) histogram of the non-null values."""
    group = list(group or [])
    return (df.where(F.col(value).isNotNull()).groupBy(*group, value)
            .agg(F.count(F.lit(1)).alias("n")))


def percentiles_from_counts(counts: DataFrame, value: str, ps: dict[str, float],
                            group: list[str] | None = None, n_col: str = "n") -> DataFrame:
    """Exact linear-interpolation percentiles from a ``(group..., value, n)``
    histogram.  ``ps`` maps output column -> p.  -> (group..., <cols>); groups
    without values are absent."""
    group = list(group or [])
    g = group or ["_one"]
    h = counts.select(*group, F.col(value).cast("double").alias("_v"), F.col(n_col).cast("long").alias("_n"))
    if not group:
        h = h.withColumn("_one", F.lit(0))
    cum = global_running_sums(h, [F.col(c).asc() for c in g] + [F.col("_v").asc()], ["_n"], range_col="_range")
    # group totals and the count of all rows in earlier groups (one row per group)
    tot = cum.groupBy(*g).agg(F.sum("_n").alias("_N"))       # of the rows that are written, not of their lineage
    tot = global_running_sums(tot, [F.col(c).asc() for c in g], ["_N"], prefix="_cumN")
    tot = tot.select(*g, "_N", (F.col("_cumN_N") - F.col("_N")).alias("_off"))
    targets = []
    for name, p in ps.items():
        pos = F.lit(float(p)) * (F.col("_N") - F.lit(1))
        for side, r in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            targets.append(tot.select(*g, F.lit(name).alias("_p"), F.lit(side).alias("_side"),
                                      (pos - F.floor(pos)).alias("_frac"),
                                      (F.col("_off") + r.cast("long")).alias("_a")))
    t = targets[0]
    for x in targets[1:]:
        t = t.unionByName(x)
    # the row whose cumulative range [cum - n, cum) holds absolute rank _a
    ends = sorted((r["m"], r["_range"]) for r in cum.groupBy("_range").agg(F.max("cum__n").alias("m")).collect())
    if ends:
        passed = F.size(F.filter(F.array(*[F.lit(m) for m, _ in ends]), lambda m: m <= F.col("_a")))
        t = t.withColumn("_range", F.element_at(F.array(*[F.lit(r) for _, r in ends]), F.least(passed + 1, F.lit(len(ends)))))
    else:
        t = t.withColumn("_range", F.lit(0))
    hit = (cum.join(t, [*g, "_range"]).where((F.col("_a") >= F.col("cum__n") - F.col("_n")) & (F.col("_a") < F.col("cum__n")))
           .select(*g, "_p", "_side", "_frac", "_v"))
    lo = hit.where(F.col("_side") == "lo").select(*g, "_p", "_frac", F.col("_v").alias("_lo"))
    hi = hit.where(F.col("_side") == "hi").select(*g, "_p", F.col("_v").alias("_hi"))
    val = lo.join(hi, g + ["_p"]).select(*g, "_p", (F.col("_lo") + F.col("_frac") * (F.col("_hi") - F.col("_lo")))
                                         .alias("_val"))
    wide = val.groupBy(*g).pivot("_p", list(ps)).agg(F.first("_val"))
    return wide.drop("_one") if not group else wide


def exact_percentiles(df: DataFrame, value: str, ps: dict[str, float], group: list[str] | None = None) -> DataFrame:
    """``percentile(value, p)`` per group for every p in ``ps``, exactly."""
    return percentiles_from_counts(value_counts(df, value, group), value, ps, group)
