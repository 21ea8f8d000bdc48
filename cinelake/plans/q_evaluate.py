"""Registered queries: temporal splits, ground truth, sampling, ranking metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinelake.operators import evaluate as V
from cinelake.operators import popularity as P
from cinelake.plans.registry import query
from cinelake.sources import tables as S

SPLIT_SQL = """
, split AS (
  SELECT userId, movieId, rating, ts, (n >= 5 AND rn <= greatest(1, floor(n * 0.2E0))) AS is_test
  FROM (SELECT *, count(*) OVER (PARTITION BY userId) AS n,
               row_number() OVER (PARTITION BY userId ORDER BY ts DESC, movieId DESC) AS rn FROM interactions))
, train AS (SELECT userId, movieId, rating, ts FROM split WHERE NOT is_test)
, test AS (SELECT userId, movieId, rating, ts FROM split WHERE is_test)
, truth AS (SELECT DISTINCT userId, movieId FROM test WHERE rating >= 4.0E0)
, eusers AS (SELECT DISTINCT userId FROM truth)
, train_pop AS (
  SELECT movieId, count(*) AS n_ratings, avg(rating) AS mean_rating,
    count(*) / (count(*) + 50.0E0) * avg(rating)
    + 50.0E0 / (count(*) + 50.0E0) * (SELECT avg(rating) FROM train) AS score
  FROM train GROUP BY movieId)"""

POP_RECS_SQL = """
, recs AS (
  SELECT u.userId, t.rank, t.movieId FROM eusers u CROSS JOIN (
    SELECT movieId, row_number() OVER (ORDER BY score DESC, movieId) AS rank
    FROM (SELECT * FROM train_pop ORDER BY score DESC, movieId LIMIT 20)) t)"""


def metrics_sql(model: str) -> str:
    """Metric CTEs over ``recs(userId, rank, movieId)``; yields the final SELECT."""
    return f"""
, ks AS (SELECT CAST(unnest([5, 10, 20]) AS BIGINT) AS k)
, hits AS (
  SELECT r.userId, r.rank, CASE WHEN t.userId IS NULL THEN 0 ELSE 1 END AS hit
  FROM recs r JOIN eusers u ON u.userId = r.userId
  LEFT JOIN truth t ON t.userId = r.userId AND t.movieId = r.movieId WHERE r.rank <= 20)
, cum AS (SELECT *, sum(hit) OVER (PARTITION BY userId ORDER BY rank
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM hits)
, per AS (SELECT c.userId, ks.k, sum(hit) AS hits, sum(hit * cum / rank) AS ap_sum,
                 sum(hit / log2(rank + 1)) AS dcg
          FROM cum c JOIN ks ON c.rank <= ks.k GROUP BY c.userId, ks.k)
, nrel AS (SELECT userId, count(*) AS n_rel FROM truth GROUP BY userId)
, base AS (
  SELECT u.userId, ks.k, n.n_rel, coalesce(p.hits, 0) AS hits, coalesce(p.ap_sum, 0) AS ap_sum,
         coalesce(p.dcg, 0) AS dcg
  FROM eusers u CROSS JOIN ks JOIN nrel n ON n.userId = u.userId
  LEFT JOIN per p ON p.userId = u.userId AND p.k = ks.k)
, rk AS (
  SELECT k, avg(hits / k) AS precision, avg(hits / n_rel) AS recall, avg(ap_sum / least(n_rel, k)) AS map,
    avg(dcg / list_sum(list_transform(range(1, least(n_rel, k) + 1), lambda i: 1.0E0 / log2(i + 1)))) AS ndcg
  FROM base GROUP BY k)
, top10 AS (SELECT r.* FROM recs r JOIN eusers u ON u.userId = r.userId WHERE r.rank <= 10)
, gv AS (
  SELECT movieId, token, len(toks) AS n_tokens FROM (
    SELECT movieId, list_distinct(string_split(lower(coalesce(genres, '')), '|')) AS toks FROM movies),
  unnest(toks) AS t(token))
, rl AS (SELECT r.userId, r.rank, r.movieId, g.n_tokens FROM top10 r
         JOIN (SELECT DISTINCT movieId, n_tokens FROM gv) g ON g.movieId = r.movieId)
, pairs AS (SELECT a.userId, a.rank AS r1, b.rank AS r2, a.movieId AS m1, b.movieId AS m2,
                   a.n_tokens AS n1, b.n_tokens AS n2
            FROM rl a JOIN rl b ON a.userId = b.userId AND a.rank < b.rank)
, shared AS (SELECT p.userId, p.r1, p.r2, count(*) AS shared FROM pairs p
             JOIN gv g1 ON g1.movieId = p.m1 JOIN gv g2 ON g2.movieId = p.m2 AND g2.token = g1.token
             GROUP BY p.userId, p.r1, p.r2)
, ild AS (
  SELECT coalesce(avg(d), 0.0E0) AS value FROM (
    SELECT p.userId, avg(1.0E0 - coalesce(s.shared, 0) / sqrt(p.n1 * p.n2)) AS d
    FROM pairs p LEFT JOIN shared s ON s.userId = p.userId AND s.r1 = p.r1 AND s.r2 = p.r2
    GROUP BY p.userId))
SELECT '{model}' AS model, metric, k, value FROM (
  SELECT 'precision' AS metric, k, precision AS value FROM rk
  UNION ALL SELECT 'recall', k, recall FROM rk
  UNION ALL SELECT 'map', k, map FROM rk
  UNION ALL SELECT 'ndcg', k, ndcg FROM rk
  UNION ALL SELECT 'coverage', CAST(10 AS BIGINT),
    (SELECT count(DISTINCT movieId) FROM top10) / greatest(1, (SELECT count(*) FROM movies))
  UNION ALL SELECT 'novelty', CAST(10 AS BIGINT), (
    SELECT coalesce(avg(-log2(greatest(1e-9, coalesce(p.n, 1) / (SELECT count(*) FROM train)))), 0.0E0)
    FROM top10 r LEFT JOIN (SELECT movieId, count(*) AS n FROM train GROUP BY movieId) p ON p.movieId = r.movieId)
  UNION ALL SELECT 'intra_list_diversity', CAST(10 AS BIGINT), value FROM ild)"""


def _split(spark, sf):
    return V.split_user(S.interactions(spark, sf))


@query("temporal_split_user", code="W1", sql=SPLIT_SQL + "\nSELECT userId, movieId, is_test FROM split")
def q_split_user(spark, sf):
    return V.temporal_split_user(S.interactions(spark, sf)).select("userId", "movieId", "is_test")


@query("temporal_split_global", code="W2", sql="""
SELECT userId, movieId, epoch(ts) > (SELECT quantile_cont(floor(epoch(ts)), 0.8) FROM interactions) AS is_test
FROM interactions""")
def q_split_global(spark, sf):
    return V.temporal_split_global(S.interactions(spark, sf)).select("userId", "movieId", "is_test")


@query("ground_truth", code="E1", sql=SPLIT_SQL + "\nSELECT userId, movieId FROM truth")
def q_ground_truth(spark, sf):
    _, test = _split(spark, sf)
    return V.ground_truth(test)


@query("eval_sample", code="E9", sql=SPLIT_SQL + """
SELECT userId FROM eusers ORDER BY (userId * 2654435761 + 42) % 4294967296, userId LIMIT 100""")
def q_eval_sample(spark, sf):
    _, test = _split(spark, sf)
    return V.eval_sample(V.ground_truth(test), 100)


@query("class_balance", code="P11", floats=("positive_share",), sql=SPLIT_SQL + """
SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS part, count(*) AS n,
  avg(CASE WHEN rating >= 4.0E0 THEN 1.0E0 ELSE 0.0E0 END) AS positive_share FROM split GROUP BY 1""")
def q_class_balance(spark, sf):
    s = V.temporal_split_user(S.interactions(spark, sf))
    return s.groupBy(F.when(F.col("is_test"), "test").otherwise("train").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("rating") >= 4.0).cast("double")).alias("positive_share"))


@query("evaluate_popularity", code="E2-E8/E10", floats=("value",),
       sql=SPLIT_SQL + POP_RECS_SQL + metrics_sql("popularity"))
def q_evaluate_popularity(spark, sf):
    train, test = _split(spark, sf)
    m = S.movies(spark, sf)
    users = V.eval_sample(V.ground_truth(test), None)
    recs = P.popularity_for_users(users, train, k=20)
    return V.evaluate_model(recs, test, train, m, "popularity")


def one_metric_sql(model: str, metrics: tuple[str, ...]) -> str:
    """``metrics_sql`` with the final union kept as a CTE and filtered."""
    full = metrics_sql(model)
    head = f"\nSELECT '{model}' AS model, metric, k, value FROM ("
    assert head in full
    names = ", ".join(f"'{m}'" for m in metrics)
    return (full.replace(head, f"\n, allmet AS (SELECT '{model}' AS model, metric, k, value FROM (")
            + f")\nSELECT model, metric, k, value FROM allmet WHERE metric IN ({names})")


def _pop_eval_inputs(spark, sf):
    """(recs, truth, users, train, movies) of the popularity model on the split;
    the recommendation lists are materialised once (they feed every metric)."""
    from cinelake.session import cut_lineage
    train, test = _split(spark, sf)
    truth = cut_lineage(V.ground_truth(test))
    users = cut_lineage(V.eval_sample(truth, None))
    recs = cut_lineage(P.popularity_for_users(users, train, k=20).select("userId", "rank", "movieId"))
    return recs, truth, users, train, S.movies(spark, sf)


def _as_model(df, model="popularity"):
    return df.select(F.lit(model).alias("model"), "metric", F.col("k").cast("int").alias("k"), "value")


def _ranking_metric(spark, sf, metric):
    recs, truth, users, _, _ = _pop_eval_inputs(spark, sf)
    return _as_model(V.ranking_metrics(recs, truth, users).where(F.col("metric") == metric))


EVAL_POP = SPLIT_SQL + POP_RECS_SQL


@query("precision_at_k", code="E2", floats=("value",), sql=EVAL_POP + one_metric_sql("popularity", ("precision",)))
def q_precision_at_k(spark, sf):
    return _ranking_metric(spark, sf, "precision")


@query("recall_at_k", code="E3", floats=("value",), sql=EVAL_POP + one_metric_sql("popularity", ("recall",)))
def q_recall_at_k(spark, sf):
    return _ranking_metric(spark, sf, "recall")


@query("map_at_k", code="E4", floats=("value",), sql=EVAL_POP + one_metric_sql("popularity", ("map",)))
def q_map_at_k(spark, sf):
    return _ranking_metric(spark, sf, "map")


@query("ndcg_at_k", code="E5", floats=("value",), sql=EVAL_POP + one_metric_sql("popularity", ("ndcg",)))
def q_ndcg_at_k(spark, sf):
    return _ranking_metric(spark, sf, "ndcg")


@query("catalog_coverage", code="E6", floats=("value",),
       sql=EVAL_POP + one_metric_sql("popularity", ("coverage",)))
def q_catalog_coverage(spark, sf):
    recs, _, users, _, m = _pop_eval_inputs(spark, sf)
    return _as_model(V.coverage(recs, users, m.agg(F.count(F.lit(1)).alias("n_catalog"))))


@query("novelty", code="E7", floats=("value",), sql=EVAL_POP + one_metric_sql("popularity", ("novelty",)))
def q_novelty(spark, sf):
    recs, _, users, train, _ = _pop_eval_inputs(spark, sf)
    return _as_model(V.novelty(recs, users, train))


@query("intra_list_diversity", code="E8", floats=("value",),
       sql=EVAL_POP + one_metric_sql("popularity", ("intra_list_diversity",)))
def q_intra_list_diversity(spark, sf):
    recs, _, users, _, m = _pop_eval_inputs(spark, sf)
    return _as_model(V.intra_list_diversity(recs, users, m))


UNSEEN_RECS_SQL = """
, recs AS (
  SELECT userId, rank, movieId FROM (
    SELECT u.userId, p.movieId, row_number() OVER (PARTITION BY u.userId ORDER BY p.score DESC, p.movieId) AS rank
    FROM eusers u CROSS JOIN train_pop p
    WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.userId = u.userId AND t.movieId = p.movieId))
  WHERE rank <= 20)"""


@query("evaluate_model", code="E10", floats=("value",),
       sql=SPLIT_SQL + UNSEEN_RECS_SQL + metrics_sql("popularity_unseen"))
def q_evaluate_model(spark, sf):
    """E10 for the popularity recommender that skips each user's training
    items: lists of depth max(K) = 20, every metric in one job."""
    train, test = _split(spark, sf)
    users = V.eval_sample(V.ground_truth(test), None)
    recs = P.popularity_for_users(users, train, k=20, exclude_seen=True)
    return V.evaluate_model(recs, test, train, S.movies(spark, sf), "popularity_unseen")
