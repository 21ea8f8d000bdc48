"""Leakage-safe temporal splits (W1, W2), ground truth (E1), user sampling
and the ranking-metric job (E2-E8, E10, E12).

Recommendation lists are long tables ``(userId, rank, movieId)``; every metric
is a sum over list rows joined with the user's ground truth, so the whole
evaluation is joins + one window (running hits) + aggregates, with no list
ever collected to the driver or into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.operators.prep import epoch_seconds, hash_key

DEFAULT_KS = (5, 10, 20)


def temporal_split_user(ratings: DataFrame, test_ratio: float = 0.2, min_history: int = 5) -> DataFrame:
    """Adds ``is_test``.  Per user the latest ``max(1, int(n*ratio))`` rows
    (by ts, then movieId) are test; users with fewer than ``min_history``
    ratings stay wholly in train.  The per-user count is an aggregate joined
    back; the recency rank is ``rank_within`` (range-partitioned), so a user
    holding a large share of all ratings is not sorted in one task."""
    from cinelake.functions.ranking import rank_within
    r = rank_within(ratings, "userId", [F.col("ts").desc(), F.col("movieId").desc()], out="_rn")
    n = r.groupBy("userId").agg(F.count(F.lit(1)).alias("_n"))
    n_test = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(test_ratio)))
    return (r.join(n, "userId").withColumn("is_test", (F.col("_n") >= min_history) & (F.col("_rn") <= n_test))
            .drop("_n", "_rn"))


def split_user(ratings: DataFrame, test_ratio: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; the split is written once and both parts read it."""
    from cinelake.session import cut_lineage
    s = cut_lineage(temporal_split_user(ratings, test_ratio))
    return s.where(~F.col("is_test")).drop("is_test"), s.where(F.col("is_test")).drop("is_test")


def temporal_split_global(ratings: DataFrame, test_ratio: float = 0.2) -> DataFrame:
    """cutoff = linear quantile (1-ratio) of the timestamp; ``<=`` train.
    The quantile comes from a per-second histogram (exact, no task holds
    every distinct timestamp); the cutoff is a one-row frame broadcast back."""
    from cinelake.functions.quantiles import exact_percentiles
    e = epoch_seconds("ts")
    cut = exact_percentiles(ratings.select(e.alias("_e")), "_e", {"cutoff": 1.0 - test_ratio})
    return ratings.crossJoin(F.broadcast(cut)).withColumn("is_test", e > F.col("cutoff")).drop("cutoff")


def ground_truth(test: DataFrame, threshold: float = 4.0) -> DataFrame:
    """(userId, movieId) of relevant test items."""
    return test.where(F.col("rating") >= F.lit(threshold)).select("userId", "movieId").distinct()


def eval_sample(truth: DataFrame, n: int | None, seed: int = 42) -> DataFrame:
    """At most n evaluation users without replacement, by arithmetic-hash
    order (reproducible in any engine).  ``None`` keeps every user."""
    users = truth.select("userId").distinct()
    if n is None:
        return users
    return users.withColumn("_h", hash_key("userId", seed=seed)).orderBy("_h", "userId").limit(n).drop("_h")


def _idcg(n_rel):
    return F.aggregate(F.sequence(F.lit(1), n_rel), F.lit(0.0),
                       lambda acc, i: acc + F.lit(1.0) / F.log2(i + F.lit(1)))


def ranking_metrics(recs: DataFrame, truth: DataFrame, users: DataFrame, ks=DEFAULT_KS) -> DataFrame:
    """E2-E5 per (k): mean over ``users`` of precision (hits/k), recall
    (hits/|T|), MAP (sum of precision at hits / min(|T|, k)) and NDCG (binary
    gain, log2(rank+1) discount, ideal over min(|T|, k)).  Users without a list
    score 0.  Output long: (metric, k, value)."""
    kmax = max(ks)
    r = recs.where(F.col("rank") <= kmax).join(users, "userId", "left_semi")
    hit = r.join(truth.withColumn("hit", F.lit(1)), ["userId", "movieId"], "left").fillna(0, subset=["hit"])
    w = Window.partitionBy("userId").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    hit = hit.withColumn("cum", F.sum("hit").over(w))
    kdf = hit.sparkSession.createDataFrame([(k,) for k in ks], "k int")
    per = (hit.crossJoin(F.broadcast(kdf)).where(F.col("rank") <= F.col("k"))   # len(ks) fixed
           .groupBy("userId", "k").agg(F.sum("hit").alias("hits"),
                                       F.sum(F.col("hit") * F.col("cum") / F.col("rank")).alias("ap_sum"),
                                       F.sum(F.col("hit") / F.log2(F.col("rank") + 1)).alias("dcg")))
    n_rel = truth.join(users, "userId", "left_semi").groupBy("userId").agg(F.count(F.lit(1)).alias("n_rel"))
    base = users.crossJoin(F.broadcast(kdf)).join(n_rel, "userId").join(per, ["userId", "k"], "left").fillna(
        0, subset=["hits", "ap_sum", "dcg"])
    m = base.select(
        "k",
        (F.col("hits") / F.col("k")).alias("precision"),
        (F.col("hits") / F.col("n_rel")).alias("recall"),
        (F.col("ap_sum") / F.least(F.col("n_rel"), F.col("k"))).alias("map"),
        (F.col("dcg") / _idcg(F.least(F.col("n_rel"), F.col("k")))).alias("ndcg"))
    agg = m.groupBy("k").agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "map", "ndcg")])
    return agg.select("k", F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"))
                                               for c in ("precision", "recall", "map", "ndcg")])).alias("s")
                      ).select("s.metric", "k", "s.value")


def coverage(recs: DataFrame, users: DataFrame, catalog_size: DataFrame, k: int = 10) -> DataFrame:
    """Distinct items in the top-k lists / max(1, catalog size)."""
    d = recs.where(F.col("rank") <= k).join(users, "userId", "left_semi").agg(
        F.countDistinct("movieId").alias("d"))
    return d.crossJoin(catalog_size).select(F.lit("coverage").alias("metric"), F.lit(k).alias("k"),
                                            (F.col("d") / F.greatest(F.lit(1), F.col("n_catalog"))).alias("value"))


def novelty(recs: DataFrame, users: DataFrame, train: DataFrame, k: int = 10) -> DataFrame:
    """Mean over list rows of -log2(max(1e-9, pop/total)); pop from train
    counts, unknown items count 1."""
    pop = train.groupBy("movieId").agg(F.count(F.lit(1)).alias("pop"))
    total = train.agg(F.count(F.lit(1)).alias("total"))
    r = recs.where(F.col("rank") <= k).join(users, "userId", "left_semi").join(pop, "movieId", "left")
    r = r.crossJoin(F.broadcast(total)).withColumn("pop", F.coalesce("pop", F.lit(1)))
    nov = -F.log2(F.greatest(F.lit(1e-9), F.col("pop") / F.col("total")))
    return r.agg(F.coalesce(F.avg(nov), F.lit(0.0)).alias("value")).select(
        F.lit("novelty").alias("metric"), F.lit(k).alias("k"), "value")


def genre_vectors(movies: DataFrame) -> DataFrame:
    """Binary genre vectors as (movieId, token, n_tokens): lower-cased raw pipe
    parts (null genres -> one empty token), distinct."""
    toks = F.array_distinct(F.split(F.lower(F.coalesce(F.col("genres"), F.lit(""))), r"\|"))
    return movies.select("movieId", toks.alias("toks")).select(
        "movieId", F.explode("toks").alias("token"), F.size("toks").alias("n_tokens"))


def shared_tokens(pairs: DataFrame, gv: DataFrame) -> DataFrame:
    """(m1, m2, n): the tokens that two movies share, one row for each two
    movies in however many lists they stand together."""
    t1 = gv.select(F.col("movieId").alias("m1"), "token")
    t2 = gv.select(F.col("movieId").alias("m2"), "token")
    return pairs.select("m1", "m2").distinct().join(t1, "m1").join(t2, ["m2", "token"]).groupBy("m1", "m2").agg(F.count(F.lit(1)).alias("n"))


def intra_list_diversity(recs: DataFrame, users: DataFrame, movies: DataFrame, k: int = 10) -> DataFrame:
    """Mean over lists of the mean pairwise cosine distance of genre
    vectors.  Pairs are formed *within one list* (k x (k-1)/2 per user, k
    fixed); the tokens that two movies share are counted once for each two
    movies of any list, so a movie in very many lists is one key's few rows."""
    gv = genre_vectors(movies)
    r = (recs.where(F.col("rank") <= k).join(users, "userId", "left_semi")
         .join(gv.select("movieId", "n_tokens").distinct(), "movieId"))       # known vectors only
    a = r.select("userId", F.col("rank").alias("r1"), F.col("movieId").alias("m1"), F.col("n_tokens").alias("n1"))
    b = r.select("userId", F.col("rank").alias("r2"), F.col("movieId").alias("m2"), F.col("n_tokens").alias("n2"))
    pairs = a.join(b, "userId").where(F.col("r1") < F.col("r2"))
    both = shared_tokens(pairs, gv)
    shared = pairs.join(both, ["m1", "m2"]).groupBy("userId", "r1", "r2").agg(F.sum("n").alias("shared"))
    p = pairs.join(shared, ["userId", "r1", "r2"], "left").fillna(0, subset=["shared"])
    p = p.withColumn("dist", F.lit(1.0) - F.col("shared") / F.sqrt(F.col("n1") * F.col("n2")))
    per_list = p.groupBy("userId").agg(F.avg("dist").alias("d"))
    return per_list.agg(F.coalesce(F.avg("d"), F.lit(0.0)).alias("value")).select(
        F.lit("intra_list_diversity").alias("metric"), F.lit(k).alias("k"), "value")


def evaluate_model(recs: DataFrame, test: DataFrame, train: DataFrame, movies: DataFrame, model: str,
                   threshold: float = 4.0, sample_users: int | None = None, ks=DEFAULT_KS) -> DataFrame:
    """Every metric for one model as (model, metric, k, value)."""
    from cinelake.session import cut_lineage
    # the lists feed four metric branches: compute them once
    recs = cut_lineage(recs.select("userId", "rank", "movieId"))
    truth = cut_lineage(ground_truth(test, threshold))
    users = cut_lineage(eval_sample(truth, sample_users))
    cat = movies.agg(F.count(F.lit(1)).alias("n_catalog"))
    parts = [ranking_metrics(recs, truth, users, ks), coverage(recs, users, cat), novelty(recs, users, train),
             intra_list_diversity(recs, users, movies)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(model).alias("model"), "metric", F.col("k").cast("int").alias("k"), "value")


def personalization_lift(metrics: DataFrame, baseline: str, k: int = 10) -> DataFrame:
    """(model - baseline) / max(1e-5, baseline) * 100 for precision and recall at k."""
    m = metrics.where((F.col("k") == k) & F.col("metric").isin("precision", "recall"))
    b = m.where(F.col("model") == baseline).select("metric", F.col("value").alias("base"))
    return (m.where(F.col("model") != baseline).join(b, "metric")
            .select("model", "metric", (
                (F.col("value") - F.col("base")) / F.greatest(F.lit(1e-5), F.col("base")) * 100).alias("lift_pct")))


def report_table(metrics: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per model, one column per metric@k.  With the column list
    given, the pivot needs no extra job to discover the values."""
    names = metrics.select(F.concat(F.col("metric"), F.lit("@"), F.col("k").cast("string")).alias("name"),
                           "model", "value")
    g = names.groupBy("model")
    return (g.pivot("name", columns) if columns else g.pivot("name")).agg(F.max("value"))


def write_report(report: DataFrame, path: str) -> None:
    """S13 sink: the benchmark table as one CSV file with a header."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
