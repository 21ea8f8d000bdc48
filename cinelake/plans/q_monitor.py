"""Registered queries: drift, PSI, latency buffer and the streaming monitors."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinelake.operators import monitor as T
from cinelake.plans.registry import query
from cinelake.sources import tables as S

KS_P_SQL = """CASE WHEN lam < 0.2 THEN 1.0E0 ELSE least(1.0E0, greatest(0.0E0, 2.0E0 * list_sum(list_transform(
  range(1, 101), lambda k: pow(-1.0E0, k - 1) * exp(-2.0E0 * k * k * lam * lam))))) END"""


def ks_report_sql(stat: str, keys: str = "") -> str:
    return f"""
SELECT {keys} CASE WHEN n_live < 3 THEN 'INSUFFICIENT_DATA' ELSE 'SUCCESS' END AS status,
  CASE WHEN n_live < 3 THEN 0.0E0 ELSE D END AS ks_statistic,
  CASE WHEN n_live < 3 THEN 1.0E0 ELSE {KS_P_SQL} END AS p_value,
  (n_live >= 3 AND (CASE WHEN n_live < 3 THEN 1.0E0 ELSE {KS_P_SQL} END) < 0.05) AS drift_detected,
  n_live AS sample_size,
  CASE WHEN n_live < 3 THEN 'Insufficient data points for KS test.'
       WHEN {KS_P_SQL} < 0.05 THEN 'Significant distribution drift detected (p < 0.05).'
       ELSE 'No significant drift detected.' END AS interpretation
FROM (SELECT *, D * sqrt(n_base * n_live / (n_base + n_live)) AS lam FROM {stat})"""


@query("ks_drift", code="T1", floats=("ks_statistic", "p_value"), sql="""
, b AS (SELECT rating AS x, count(*) AS cb FROM rating_feed WHERE event_type = 'view' GROUP BY 1)
, l AS (SELECT rating AS x, count(*) AS cl FROM rating_feed WHERE event_type = 'purchase' GROUP BY 1)
, j AS (SELECT coalesce(b.x, l.x) AS x, coalesce(cb, 0) AS cb, coalesce(cl, 0) AS cl
        FROM b FULL OUTER JOIN l ON b.x = l.x)
, c AS (SELECT x, sum(cb) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_cb,
               sum(cl) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_cl FROM j)
, st AS (SELECT n_base, n_live, max(abs(cum_cb / n_base - cum_cl / n_live)) AS D
         FROM c, (SELECT sum(cb) AS n_base, sum(cl) AS n_live FROM j) GROUP BY n_base, n_live)"""
    + ks_report_sql("st"))
def q_ks_drift(spark, sf):
    f = S.rating_feed(spark, sf)
    return T.ks_drift(f.where(F.col("event_type") == "view"), f.where(F.col("event_type") == "purchase"))


@query("rating_drift_exact", code="T1 (exact p)")
def q_rating_drift_exact(spark, sf):
    """Daily KS drift with the exact p-value where both samples have at most
    10,000 values (no SQL form; checked by enumeration in tests)."""
    return T.rating_drift_by_day(S.rating_feed(spark, sf), exact_below=10_000)


@query("psi", code="T4", floats=("psi",), sql="""
, b AS (SELECT rating AS x, count(*) AS cb FROM rating_feed WHERE event_type = 'view' GROUP BY 1)
, l AS (SELECT rating AS x, count(*) AS cl FROM rating_feed WHERE event_type = 'purchase' GROUP BY 1)
, j AS (SELECT coalesce(cb, 0) AS cb, coalesce(cl, 0) AS cl FROM b FULL OUTER JOIN l ON b.x = l.x)
, t AS (SELECT sum(cb) AS tb, sum(cl) AS tl FROM j)
SELECT sum((greatest(cl / tl, 1e-4) - greatest(cb / tb, 1e-4)) * ln(greatest(cl / tl, 1e-4) / greatest(cb / tb, 1e-4)))
  AS psi, count(*) AS n_bins FROM j, t""")
def q_psi(spark, sf):
    f = S.rating_feed(spark, sf)
    return T.psi(f.where(F.col("event_type") == "view"), f.where(F.col("event_type") == "purchase"))


@query("psi_latency", code="T4 (continuous)", floats=("upper", "psi"), sql="""
, b AS (SELECT latency_ms AS x FROM rating_feed WHERE event_type = 'view' AND latency_ms IS NOT NULL)
, l AS (SELECT latency_ms AS x FROM rating_feed WHERE event_type = 'purchase' AND latency_ms IS NOT NULL)
, r AS (SELECT x, row_number() OVER (ORDER BY x) AS rn, count(*) OVER () AS n FROM b)
, e AS (SELECT list_sort(list(DISTINCT x)) AS edges FROM r
        WHERE list_contains(list_transform(range(1, 10), lambda i: (n * i + 9) // 10), rn))
, bins AS (SELECT unnest(range(0, len(edges) + 1)) AS bin, edges FROM e)
, cb AS (SELECT len(list_filter(edges, lambda v: v < x)) AS bin, count(*) AS n FROM b, e GROUP BY 1)
, cl AS (SELECT len(list_filter(edges, lambda v: v < x)) AS bin, count(*) AS n FROM l, e GROUP BY 1)
, s AS (SELECT bins.bin, edges[bins.bin + 1] AS upper, coalesce(cb.n, 0) AS n_base, coalesce(cl.n, 0) AS n_live,
          greatest(coalesce(cb.n, 0) / (SELECT count(*) FROM b), 1e-4) AS eb, greatest(coalesce(cl.n, 0) / (SELECT count(*) FROM l), 1e-4) AS al
        FROM bins LEFT JOIN cb ON cb.bin = bins.bin LEFT JOIN cl ON cl.bin = bins.bin)
SELECT bin, upper, n_base, n_live, (al - eb) * ln(al / eb) AS psi FROM s""")
def q_psi_latency(spark, sf):
    """Ten bins over the latency, cut at baseline ranks."""
    f = S.rating_feed(spark, sf)
    return T.psi_binned(f.where(F.col("event_type") == "view"), f.where(F.col("event_type") == "purchase"), "latency_ms")


@query("latency_last_n", code="W10", floats=("latency_ms",), sql="""
SELECT event_id, latency_ms, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS recency FROM (
  SELECT * FROM rating_feed ORDER BY ts DESC, event_id DESC LIMIT 10000)""")
def q_latency_last_n(spark, sf):
    return T.latency_last_n(S.rating_feed(spark, sf)).select("event_id", "latency_ms", "recency")


@query("latency_summary", code="A25", floats=("p50", "p95", "p99", "mean"), sql="""
SELECT coalesce(quantile_cont(latency_ms, 0.5), 0.0E0) AS p50, coalesce(quantile_cont(latency_ms, 0.95), 0.0E0) AS p95,
  coalesce(quantile_cont(latency_ms, 0.99), 0.0E0) AS p99, coalesce(avg(latency_ms), 0.0E0) AS mean, count(*) AS n
FROM (SELECT * FROM rating_feed ORDER BY ts DESC, event_id DESC LIMIT 10000)""")
def q_latency_summary(spark, sf):
    return T.latency_summary(T.latency_last_n(S.rating_feed(spark, sf)))


@query("rating_drift_by_day", code="T2 (batch twin)", floats=("ks_statistic", "p_value"), sql="""
, b AS (SELECT rating AS x, count(*) AS cb FROM rating_feed WHERE event_type = 'view' GROUP BY 1)
, nb AS (SELECT sum(cb) AS n_base FROM b)
, l AS (SELECT strftime(ts, '%Y-%m-%d') AS day, rating AS x, count(*) AS cl FROM rating_feed
        WHERE event_type = 'purchase' GROUP BY 1, 2)
, nl AS (SELECT day, sum(cl) AS n_live FROM l GROUP BY day)
, xs AS (SELECT x FROM b UNION SELECT x FROM l)
, g AS (SELECT nl.day, xs.x, coalesce(b.cb, 0) AS cb, coalesce(l.cl, 0) AS cl, nl.n_live, nb.n_base
        FROM nl CROSS JOIN xs LEFT JOIN b ON b.x = xs.x LEFT JOIN l ON l.day = nl.day AND l.x = xs.x, nb)
, st AS (SELECT day, n_base, n_live, max(abs(fb - fl)) AS D FROM (
           SELECT *, sum(cb) OVER (PARTITION BY day ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / n_base AS fb,
                     sum(cl) OVER (PARTITION BY day ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / n_live AS fl
           FROM g) GROUP BY day, n_base, n_live)""" + ks_report_sql("st", "day,"))
def q_rating_drift_by_day(spark, sf):
    return T.rating_drift_by_day(S.rating_feed(spark, sf))


@query("latency_by_window", code="T3 (batch twin)", floats=("p50", "p95", "p99", "mean"), sql="""
SELECT CAST(floor(floor(epoch(ts)) / 21600) * 21600 AS BIGINT) AS window_start,
  quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95,
  quantile_cont(latency_ms, 0.99) AS p99, avg(latency_ms) AS mean, count(*) AS n
FROM rating_feed GROUP BY 1""")
def q_latency_by_window(spark, sf):
    return T.latency_by_window(S.rating_feed(spark, sf))


@query("popularity_by_day", code="T5 (batch twin)", floats=("score",), sql="""
, d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, movieId, rating FROM interactions)
, st AS (SELECT day, movieId, count(*) AS v, avg(rating) AS R FROM d GROUP BY day, movieId)
, c AS (SELECT day, avg(rating) AS C FROM d GROUP BY day)
, sc AS (SELECT st.day, movieId, v, v / (v + 50.0E0) * R + 50.0E0 / (v + 50.0E0) * C AS score
         FROM st JOIN c ON c.day = st.day)
, top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY score DESC, movieId) AS day_rank
                        FROM sc) WHERE day_rank <= 10)
, base_top AS (SELECT movieId, row_number() OVER (ORDER BY score DESC, movieId) AS base_rank
               FROM (SELECT * FROM pop ORDER BY score DESC, movieId LIMIT 10))
SELECT t.day, t.day_rank, t.movieId, t.v, t.score, b.base_rank FROM top t LEFT JOIN base_top b ON b.movieId = t.movieId""")
def q_popularity_by_day(spark, sf):
    return T.popularity_by_day(S.interactions(spark, sf))


@query("stream_latency_windows", code="T3 (stream)", floats=("p50", "p95", "p99", "mean"), sql="""
SELECT * FROM (
  SELECT CAST(floor(floor(epoch(ts)) / 21600) * 21600 AS BIGINT) AS window_start,
    quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95,
    quantile_cont(latency_ms, 0.99) AS p99, avg(latency_ms) AS mean, count(*) AS n
  FROM rating_feed GROUP BY 1)""")
def q_stream_latency(spark, sf):
    """Structured Streaming run to completion (availableNow): latency
    counts of every window, open ones too, then exact percentiles per window
    from the counts."""
    from cinelake.streaming import drift as D
    hist = D.run_windows(D.feed_stream(spark, sf), D.latency_histogram_stream, "latency_hist")
    stats = D.run_windows(D.feed_stream(spark, sf), D.latency_mean_stream, "latency_mean")
    return T.latency_from_histogram(hist, stats)


@query("stream_rating_drift", code="T2 (stream)", floats=("D",), sql="""
, h AS (SELECT CAST(floor(floor(epoch(ts)) / 86400) * 86400 AS BIGINT) AS window_start, event_type, rating, count(*) AS n
        FROM rating_feed GROUP BY 1, 2, 3)
, hc AS (SELECT * FROM h)
, b AS (SELECT rating, sum(n) AS cb FROM hc WHERE event_type = 'view' GROUP BY rating)
, nb AS (SELECT sum(cb) AS n_base FROM b)
, l AS (SELECT window_start, rating, n AS cl FROM hc WHERE event_type = 'purchase')
, nl AS (SELECT window_start, sum(cl) AS n_live FROM l GROUP BY window_start)
, xs AS (SELECT rating FROM b UNION SELECT rating FROM l)
, g AS (SELECT nl.window_start, xs.rating, coalesce(b.cb, 0) AS cb, coalesce(l.cl, 0) AS cl, nl.n_live, nb.n_base
        FROM nl CROSS JOIN xs LEFT JOIN b ON b.rating = xs.rating
        LEFT JOIN l ON l.window_start = nl.window_start AND l.rating = xs.rating, nb)
SELECT window_start, n_base, n_live, max(abs(fb - fl)) AS D FROM (
  SELECT *, sum(cb) OVER (PARTITION BY window_start ORDER BY rating ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / n_base AS fb,
            sum(cl) OVER (PARTITION BY window_start ORDER BY rating ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / n_live AS fl
  FROM g) GROUP BY window_start, n_base, n_live""")
def q_stream_rating_drift(spark, sf):
    """T2 as a stream: daily histograms per feed part with a watermark, then
    the KS statistic of every day against the streamed baseline."""
    from cinelake.streaming import drift as D
    hist = D.run_windows(D.feed_stream(spark, sf), D.rating_histogram_stream, "rating_hist")
    return D.ks_from_histograms(hist)


@query("stream_latency_last_n", code="T3", floats=("p50", "p95", "p99", "mean"), sql="""
SELECT coalesce(quantile_cont(latency_ms, 0.5), 0.0E0) AS p50, coalesce(quantile_cont(latency_ms, 0.95), 0.0E0) AS p95,
  coalesce(quantile_cont(latency_ms, 0.99), 0.0E0) AS p99, coalesce(avg(latency_ms), 0.0E0) AS mean, count(*) AS n
FROM (SELECT * FROM rating_feed ORDER BY ts DESC, event_id DESC LIMIT 10000)""")
def q_stream_latency_last_n(spark, sf):
    """The latency feed ingested by a stateless stream (availableNow, append)
    into the shared folder; the count-based buffer of the 10,000 newest
    records and its percentiles are a distributed top-k over that table."""
    from cinelake.streaming import drift as D
    landed = D.run_to_table(D.feed_stream(spark, sf).select("event_id", "ts", "latency_ms"), "latency_feed")
    return T.latency_summary(T.latency_last_n(landed))


@query("stream_popularity", code="T5", floats=("score",), sql="""
, ev AS (SELECT l_partkey AS movieId, 0.5E0 + 0.5E0 * floor((l_quantity - 1) / 5) AS rating,
           CAST(floor(floor(epoch(l_shipdate)) / 86400) * 86400 AS BIGINT) AS window_start FROM lineitem)
, cnt AS (SELECT window_start, movieId, count(*) AS v, sum(rating) AS s FROM ev
          GROUP BY window_start, movieId)
, c AS (SELECT window_start, sum(s) / sum(v) AS C FROM cnt GROUP BY window_start)
, sc AS (SELECT n.window_start, movieId, v, v / (v + 50.0E0) * (s / v) + 50.0E0 / (v + 50.0E0) * C AS score
         FROM cnt n JOIN c ON c.window_start = n.window_start)
, top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY score DESC, movieId)
                                  AS window_rank FROM sc) WHERE window_rank <= 10)
, base_top AS (SELECT movieId, row_number() OVER (ORDER BY score DESC, movieId) AS base_rank
               FROM (SELECT * FROM pop ORDER BY score DESC, movieId LIMIT 10))
SELECT t.window_start, t.window_rank, t.movieId, t.v, t.score, b.base_rank
FROM top t LEFT JOIN base_top b ON b.movieId = t.movieId""")
def q_stream_popularity(spark, sf):
    """T5 as a stream: per-day rating counts per movie with a 1-hour
    watermark, scored against the all-time batch ranking."""
    from cinelake.operators.popularity import bayesian_popularity
    from cinelake.streaming import drift as D
    counts = D.run_windows(D.rating_event_stream(spark, sf), D.movie_popularity_stream, "movie_popularity")
    return D.window_popularity(counts, bayesian_popularity(S.interactions(spark, sf)))


SLICES = 4


def _slices():
    return [F.pmod("event_id", F.lit(SLICES)) == i for i in range(SLICES)]


@query("stream_latency_buffer", code="T3 (state)", floats=("latency_ms",), sql="""
SELECT event_id, latency_ms, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS recency FROM (
  SELECT * FROM rating_feed ORDER BY ts DESC, event_id DESC LIMIT 10000)""")
def q_stream_latency_buffer(spark, sf):
    """The rolling buffer as state of the stream: the feed lands in slices that
    are not in order of time, the stream is started again for each, and the
    shards' last buffers are merged."""
    from pyspark.sql import Window
    from cinelake.streaming import buffers as B
    feed = S.rating_feed(spark, sf).select("event_id", F.timestamp_micros(F.timestamp_diff(
        "MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts"))).alias("ts"), "latency_ms")
    newest = B.merged_buffer(B.run_in_slices(spark, feed, _slices(), B.latency_buffer_stream, "latency-buffer"))
    order = Window.orderBy(F.col("ts").desc(), F.col("event_id").desc())      # the buffer's rows
    return newest.select("event_id", "latency_ms", F.row_number().over(order).alias("recency"))


@query("stream_drift_cumulative", code="T2 (state)", floats=("ks_statistic", "p_value"), sql=f"""
, f AS (SELECT *, event_id % {SLICES} AS slice FROM rating_feed)
, b AS (SELECT rating AS x, count(*) AS cb FROM f WHERE event_type = 'view' GROUP BY 1)
, xs AS (SELECT DISTINCT rating AS x FROM f WHERE event_type IN ('view', 'purchase'))
, l AS (SELECT slice, rating AS x, count(*) AS cl FROM f WHERE event_type = 'purchase' GROUP BY 1, 2)
, g AS (SELECT s.slice AS batch, xs.x, coalesce(max(b.cb), 0) AS cb, coalesce(sum(l.cl), 0) AS cl
        FROM (SELECT DISTINCT slice FROM l) s CROSS JOIN xs LEFT JOIN b ON b.x = xs.x LEFT JOIN l ON l.x = xs.x AND l.slice <= s.slice
        GROUP BY s.slice, xs.x)
, c AS (SELECT batch, sum(cb) OVER w AS cum_cb, sum(cl) OVER w AS cum_cl, sum(cb) OVER (PARTITION BY batch) AS n_base,
               sum(cl) OVER (PARTITION BY batch) AS n_live FROM g
        WINDOW w AS (PARTITION BY batch ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
, st AS (SELECT batch, n_base, n_live, max(abs(cum_cb / n_base - cum_cl / n_live)) AS D FROM c GROUP BY batch, n_base, n_live)"""
    + ks_report_sql("st", "row_number() OVER (ORDER BY batch) AS batch,"))
def q_stream_drift_cumulative(spark, sf):
    """Drift of all live ratings so far, one row per micro-batch of the stream."""
    from pyspark.sql import Window
    from cinelake.streaming import buffers as B
    f = S.rating_feed(spark, sf)
    base = f.where(F.col("event_type") == "view")
    live = f.where(F.col("event_type") == "purchase").select("event_id", "rating")
    out = B.run_in_slices(spark, live, _slices(), lambda s: B.cumulative_drift_stream(s, base), "rating-drift")
    ordered = out.withColumn("batch", F.row_number().over(Window.orderBy("batch")))      # one row a micro-batch
    return T.ks_report(ordered)
