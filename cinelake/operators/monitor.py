"""Drift and latency monitoring in batch form (T1, T4, W10, A25, and the batch
twins of the streaming jobs T2, T3, T5).

Two-sample KS: D = max |F_base(x) - F_live(x)| from per-value counts and
distributed running sums; the p-value uses the asymptotic Kolmogorov series
``2 * sum_k (-1)^(k-1) exp(-2 k^2 lambda^2)`` with
``lambda = D * sqrt(n1 n2 / (n1 + n2))``, or, where asked for and both samples
are small, the exact probability.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.functions.ranking import global_running_sums, top_k_global

KS_TERMS = 100
PSI_EPS = 1e-4


def ks_p_value(lam):
    """Column expression: asymptotic KS p-value for ``lam`` (1.0 below 0.2, where
    the series has not converged and the true value is within 1e-6 of 1)."""
    series = F.aggregate(F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
                         lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * series)))


def ks_statistic(base: DataFrame, live: DataFrame, value: str = "rating", group: str | None = None) -> DataFrame:
    """Per group (or overall): (n_base, n_live, D).  ``live`` may carry a group
    column (e.g. a time window) that the baseline does not."""
    b = base.groupBy(F.col(value).alias("x")).agg(F.count(F.lit(1)).alias("cb"))
    nb = base.agg(F.count(F.lit(1)).alias("n_base"))
    keys = [group] if group else []
    l = live.groupBy(*keys, F.col(value).alias("x")).agg(F.count(F.lit(1)).alias("cl"))
    nl = live.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_live"))
    if group:
        return ks_from_counts(b, l, group)
    j = b.join(l, "x", "full_outer").fillna(0, subset=["cb", "cl"])
    j = global_running_sums(j, [F.col("x").asc()], ["cb", "cl"], prefix="cum_")
    j = j.crossJoin(F.broadcast(nb)).crossJoin(F.broadcast(nl))
    return j.groupBy("n_base", "n_live").agg(
        F.max(F.abs(F.col("cum_cb") / F.col("n_base") - F.col("cum_cl") / F.col("n_live"))).alias("D"))


def ks_from_counts(base: DataFrame, live: DataFrame, group: str) -> DataFrame:
    """(group, n_base, n_live, D) from value counts ``base(x, cb)`` and
    ``live(group, x, cl)``.  Between two values of a group its distribution is
    flat and the baseline's only rises, so the largest distance lies at one of
    the group's own values or just before it: the baseline is looked up at
    those alone (running sums over the union of values), and no group meets
    every baseline value."""
    both = base.unionByName(live.select("x", F.lit(0).cast("bigint").alias("cb"))).groupBy("x").agg(F.sum("cb").alias("cb"))
    at = global_running_sums(both, [F.col("x").asc()], ["cb"], prefix="cum_").select("x", "cb", "cum_cb")
    nb = base.agg(F.sum("cb").alias("n_base"))
    rows = live.select(group, "x", "cl")
    run = global_running_sums(rows, [F.col(group).asc(), F.col("x").asc()], ["cl"], prefix="cum_")
    first = run.groupBy(group).agg(F.sum("cl").alias("n_live"), F.min(F.col("cum_cl") - F.col("cl")).alias("before"))
    j = run.join(at, "x").join(first, group).crossJoin(F.broadcast(nb))      # one-row frame
    fl = (F.col("cum_cl") - F.col("before")) / F.col("n_live")
    fl_before = (F.col("cum_cl") - F.col("before") - F.col("cl")) / F.col("n_live")
    fb = F.col("cum_cb") / F.col("n_base")
    fb_before = (F.col("cum_cb") - F.col("cb")) / F.col("n_base")
    return j.groupBy(group, "n_base", "n_live").agg(
        F.max(F.greatest(F.abs(fb - fl), F.abs(fb_before - fl_before))).alias("D"))


def exact_ks_p(d: float, n1: int, n2: int) -> float:
    """P(D >= d) of the two-sample statistic when both samples come from one
    continuous distribution.  All orders of n1 + n2 values are equally likely;
    the share whose path (i/n1, j/n2) stays nearer than d to the diagonal is
    built up row by row, each row a running sum over the band that is allowed."""
    import numpy as np
    near = (np.ceil(round(d * n1 * n2, 6)) - 0.5) / (n1 * n2)       # d is a multiple of 1 / (n1 n2)
    j = np.arange(n2 + 1) / n2
    row = (j < near).astype(float)                                  # share of orders, scaled to the prefix seen
    for i in range(1, n1 + 1):
        band = np.abs(i / n1 - j) < near
        row = np.where(band, np.cumsum(np.where(band, row * (i / (i + n2)), 0.0)), 0.0)
    return float(min(1.0, max(0.0, 1.0 - row[-1])))


@F.pandas_udf(T.DoubleType())
def _exact_p(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([exact_ks_p(float(x), int(min(a, b)), int(max(a, b))) for x, a, b in zip(d, n1, n2)])


def ks_report(stat: DataFrame, min_live: int = 3, alpha: float = 0.05, exact_below: int = 0) -> DataFrame:
    """T1 result columns from (n_base, n_live, D).  Samples of at most
    ``exact_below`` values get the exact p-value, one row per comparison."""
    lam = F.col("D") * F.sqrt(F.col("n_base") * F.col("n_live") / (F.col("n_base") + F.col("n_live")))
    small = F.col("n_live") < min_live
    p = ks_p_value(lam)
    if exact_below:
        few = F.greatest("n_base", "n_live") <= exact_below
        bounded = [F.when(few, F.col(c)).otherwise(F.lit(1)) for c in ("n_base", "n_live")]      # larger ones cost nothing
        p = F.when(few, _exact_p(F.col("D"), *bounded)).otherwise(p)
    p = F.when(small, F.lit(1.0)).otherwise(p)
    d = F.when(small, F.lit(0.0)).otherwise(F.col("D"))
    drift = (~small) & (p < alpha)
    # fixed output texts
    interp = (F.when(small, F.lit("Insufficient data points for KS test."))
              .when(drift, F.lit("Significant distribution drift detected (p < 0.05)."))
              .otherwise(F.lit("No significant drift detected.")))
    keep = [c for c in stat.columns if c not in ("n_base", "n_live", "D")]
    return stat.select(*keep, F.when(small, F.lit("INSUFFICIENT_DATA")).otherwise(F.lit("SUCCESS")).alias("status"),
                       d.alias("ks_statistic"), p.alias("p_value"), drift.alias("drift_detected"),
                       F.col("n_live").alias("sample_size"), interp.alias("interpretation"))


def ks_drift(base: DataFrame, live: DataFrame, value: str = "rating", exact_below: int = 0) -> DataFrame:
    """KS drift of live vs baseline values."""
    return ks_report(ks_statistic(base, live, value), exact_below=exact_below)


def psi(base: DataFrame, live: DataFrame, value: str = "rating", eps: float = PSI_EPS) -> DataFrame:
    """T4: population stability index over the distinct values, shares floored at eps."""
    b = base.groupBy(F.col(value).alias("x")).agg(F.count(F.lit(1)).alias("cb"))
    l = live.groupBy(F.col(value).alias("x")).agg(F.count(F.lit(1)).alias("cl"))
    j = b.join(l, "x", "full_outer").fillna(0, subset=["cb", "cl"])
    t = j.agg(F.sum("cb").alias("tb"), F.sum("cl").alias("tl"))
    j = j.crossJoin(F.broadcast(t))
    e = F.greatest(F.col("cb") / F.col("tb"), F.lit(eps))
    a = F.greatest(F.col("cl") / F.col("tl"), F.lit(eps))
    return j.agg(F.sum((a - e) * F.log(a / e)).alias("psi"), F.count(F.lit(1)).alias("n_bins"))


def rank_edges(base: DataFrame, value: str, n_bins: int = 10) -> list[float]:
    """The baseline values of rank ceil(N * i / n_bins), i = 1 .. n_bins - 1,
    without repeats: n_bins - 1 numbers at most, found through a running count
    over the distinct values."""
    counts = base.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    run = global_running_sums(counts, [F.col("x").asc()], ["n"], prefix="cum_")
    total = run.agg(F.max("cum_n").alias("t")).first()["t"]
    if not total:
        return []
    ranks = [-(-total * i // n_bins) for i in range(1, n_bins)]
    held = F.exists(F.array(*[F.lit(r) for r in ranks]), lambda r: (r > F.col("cum_n") - F.col("n")) & (r <= F.col("cum_n")))
    return sorted(r["x"] for r in run.where(held).select("x").collect()) if ranks else []


def psi_binned(base: DataFrame, live: DataFrame, value: str, n_bins: int = 10, eps: float = PSI_EPS) -> DataFrame:
    """T4 of a continuous column: the bins are cut at baseline ranks, a value
    belongs to the bin of the first edge not below it (the last bin is open).
    Per bin: (bin, upper, n_base, n_live, psi); the index is the sum of ``psi``.
    Nulls are in no bin."""
    edges = rank_edges(base, value, n_bins)
    bounds = F.array(*[F.lit(e) for e in edges]) if edges else F.array().cast("array<double>")
    of = lambda c: F.size(F.filter(bounds, lambda e: e < c)).cast("int")
    one = lambda df, name: (df.where(F.col(value).isNotNull()).groupBy(of(F.col(value).cast("double")).alias("bin"))
                            .agg(F.count(F.lit(1)).alias(name)))
    spark = base.sparkSession
    bins = spark.range(len(edges) + 1).select(F.col("id").cast("int").alias("bin"), F.get(bounds, F.col("id").cast("int")).alias("upper"))
    j = bins.join(one(base, "n_base"), "bin", "left").join(one(live, "n_live"), "bin", "left").fillna(0, subset=["n_base", "n_live"])
    t = j.agg(F.sum("n_base").alias("tb"), F.sum("n_live").alias("tl"))
    j = j.crossJoin(F.broadcast(t))                                            # one-row frame
    share = lambda n, total: F.greatest(F.coalesce(F.try_divide(F.col(n), F.col(total)), F.lit(0.0)), F.lit(eps))
    e, a = share("n_base", "tb"), share("n_live", "tl")
    return j.select("bin", "upper", "n_base", "n_live", ((a - e) * F.log(a / e)).alias("psi"))


def latency_last_n(feed: DataFrame, n: int = 10_000) -> DataFrame:
    """The n most recent latency records (by ts, then event id), numbered
    by recency.  Selected exactly through an hourly histogram (newest hour
    first) so no single task merges n rows from every partition; the final
    numbering runs over the n survivors only."""
    from pyspark.sql import Window
    from cinelake.functions.ranking import first_n_exact
    from cinelake.operators.prep import epoch_seconds
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    hour_desc = -F.floor(epoch_seconds("ts") / F.lit(3600))
    top = first_n_exact(feed.select("event_id", "ts", "latency_ms"), n, order, hour_desc)
    return top.withColumn("recency", F.row_number().over(Window.orderBy(*order)))


def latency_summary(lat: DataFrame, col: str = "latency_ms") -> DataFrame:
    """p50 / p95 / p99 (linear interpolation) and mean; zeros when empty."""
    a = lat.agg(F.percentile(col, 0.5).alias("p50"), F.percentile(col, 0.95).alias("p95"),
                F.percentile(col, 0.99).alias("p99"), F.avg(col).alias("mean"), F.count(F.lit(1)).alias("n"))
    return a.select(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("p50", "p95", "p99", "mean")], "n")


def daily_windows(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Tumbling 1-day event-time window, as 'YYYY-MM-DD' (time-zone free for NTZ input)."""
    return df.withColumn("day", F.date_format(F.col(ts), "yyyy-MM-dd"))


def rating_drift_by_day(feed: DataFrame, base_type: str = "view", live_type: str = "purchase", exact_below: int = 0) -> DataFrame:
    """T2 batch twin: KS of each day's live ratings against the whole baseline."""
    base = feed.where(F.col("event_type") == base_type)
    live = daily_windows(feed.where(F.col("event_type") == live_type))
    return ks_report(ks_statistic(base, live, "rating", group="day"), exact_below=exact_below)


def latency_by_window(feed: DataFrame, hours: int = 6) -> DataFrame:
    """T3 batch twin: latency percentiles per tumbling event-time window."""
    from cinelake.operators.prep import epoch_seconds
    size = hours * 3600
    w = feed.withColumn("window_start", F.floor(epoch_seconds("ts") / F.lit(size)) * F.lit(size))
    hist = w.groupBy("window_start", "latency_ms").agg(F.count(F.lit(1)).alias("n"))
    stats = w.groupBy("window_start").agg(F.avg("latency_ms").alias("mean"), F.count(F.lit(1)).alias("n"))
    return latency_from_histogram(hist, stats)


LATENCY_PS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def latency_from_histogram(hist: DataFrame, stats: DataFrame) -> DataFrame:
    """p50 / p95 / p99 per window from ``(window_start, latency_ms, n)``
    counts, joined to ``stats`` = (window_start, mean, n) from a plain average.
    Exact percentiles through the histogram: a busy window never has its
    distinct latencies gathered in one task."""
    from cinelake.functions.quantiles import percentiles_from_counts
    vals = hist.where(F.col("latency_ms").isNotNull())
    pct = percentiles_from_counts(vals, "latency_ms", LATENCY_PS, ["window_start"])
    st = stats.select("window_start", "mean", "n")
    return st.join(pct, "window_start", "left").select("window_start", "p50", "p95", "p99", "mean", "n")


def popularity_by_day(ratings: DataFrame, m: float = 50.0, k: int = 10) -> DataFrame:
    """T5 batch twin: per day, the Bayesian score of every movie rated that day
    (C = that day's mean) and its rank change versus the all-time ranking."""
    from cinelake.functions.ranking import top_k_per_group
    from cinelake.operators.popularity import bayesian_popularity
    d = daily_windows(ratings)
    st = d.groupBy("day", "movieId").agg(F.count(F.lit(1)).alias("v"), F.avg("rating").alias("R"))
    c = d.groupBy("day").agg(F.avg("rating").alias("C"))
    mm = F.lit(float(m))
    sc = st.join(c, "day").select("day", "movieId", "v", (F.col("v") / (F.col("v") + mm) * F.col("R")
                                                          + mm / (F.col("v") + mm) * F.col("C")).alias("score"))
    top = top_k_per_group(sc, "day", k, [F.col("score").desc(), F.col("movieId").asc()], rank_col="day_rank")
    base = bayesian_popularity(ratings, m)
    base_top = top_k_global(base, k, [F.col("score").desc(), F.col("movieId").asc()], rank_col="base_rank")
    return top.join(base_top.select("movieId", "base_rank"), "movieId", "left").select(
        "day", "day_rank", "movieId", "v", "score", "base_rank")
