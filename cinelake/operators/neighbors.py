"""Neighbourhood recommenders (R1-R4, R9, R9b, R15) as set jobs over all
seeds / users at once.  Output lists are ``(seed, rank, movieId, sim)``.

Cosines of non-negative vectors go through ``pruned.pruned_topk`` (exact, with
upper bounds), those of dense vectors of any sign through ``mips.cosine_topk``
and of genre sets through ``similarity.blocked_topk`` (exact, all pairs in blocks).  R1 additionally collapses movies to their
distinct genre *sets* before scoring, because the similarity of two movies
depends only on their two sets: heavy genres then cost sets x sets, not
movies x movies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.ranking import top_k_per_group
from cinelake.functions.text import genre_vocab_array
from cinelake.operators import textfeat as X
from cinelake.operators.mips import cosine_topk
from cinelake.operators.prep import enrich_movies, frequent_tags
from cinelake.operators.pruned import candidates, pruned_topk
from cinelake.operators.similarity import blocked_topk, l2_normalize, pad_with_zero
from cinelake.session import written

SIM_DP = 12   # similarities are rounded before ranking so near-equal floats tie


def _vec(df: DataFrame, id_col: str, term_col: str, w_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(term_col).alias("term"), F.col(w_col).cast("double").alias("w"))


def _round(df: DataFrame) -> DataFrame:
    return df.withColumn("sim", F.round("sim", SIM_DP))


def _as_list(df: DataFrame, seed_name: str, k: int) -> DataFrame:
    r = top_k_per_group(_round(df), "sid", k, [F.col("sim").desc(), F.col("iid").asc()])
    return r.select(F.col("sid").alias(seed_name), "rank", F.col("iid").alias("movieId"), "sim")


def similar_by_genre(movies: DataFrame, k: int = 10) -> DataFrame:
    """Cosine over binary genre vectors; seed excluded; similarity-0
    movies fill the list when fewer than k share a genre (ids ascending)."""
    mv = movies.select("movieId", F.array_sort(genre_vocab_array(F.col("genres"))).alias("gset"))
    sets = mv.groupBy("gset").agg(F.min("movieId").alias("set_id"))
    members = mv.join(sets, "gset").select("set_id", "movieId")
    vec = sets.select(F.col("set_id").alias("id"), F.explode("gset").alias("term"), F.lit(1.0).alias("w"))
    # top (k+1) candidate *sets* per seed set, ordered (sim desc, smallest member asc); zero sims kept
    cand_sets = blocked_topk(vec, vec, k + 1, exclude_self=False, min_sim=0.0, strict=False)
    # the first k+1 members of every set are the only ones that can rank
    first = top_k_per_group(members, "set_id", k + 1, [F.col("movieId").asc()], rank_col="m_rank")
    cand = (cand_sets.select(F.col("sid").alias("seed_set"), F.col("iid").alias("set_id"), F.round("sim", SIM_DP)
                             .alias("sim"))
            .join(first, "set_id"))
    per_set = top_k_per_group(cand, "seed_set", k + 1, [F.col("sim").desc(), F.col("movieId").asc()],
                              rank_col="c_rank")
    # a list holds its own seed once at most: without it the first k are left, no seed's rows are sorted
    lists = written(per_set.groupBy("seed_set").agg(F.array_sort(F.collect_list(F.struct("c_rank", "movieId", "sim"))).alias("list")), "genre-lists")  # k + 1 rows a set
    copies = written(members.groupBy("movieId").agg(F.count(F.lit(1)).alias("n"), F.min("set_id").alias("seed_set")), "genre-members")
    once = copies.where("n = 1").join(lists, "seed_set").select(F.col("movieId").alias("seed"), F.posexplode(
        F.slice(F.filter("list", lambda r: r["movieId"] != F.col("movieId")), 1, k)).alias("at", "r"))
    once = once.select("seed", (F.col("at") + 1).alias("rank"), "r.movieId", "r.sim")
    # movies of several rows: the lists of all of them together
    again = members.join(copies.where("n > 1").select("movieId"), "movieId").select(F.col("set_id").alias("seed_set"), F.col("movieId").alias("seed"))
    pairs = again.join(per_set, "seed_set").where(F.col("movieId") != F.col("seed"))
    more = top_k_per_group(pairs, "seed", k, [F.col("sim").desc(), F.col("movieId").asc()])
    return once.unionByName(more.select("seed", "rank", "movieId", "sim"))


def tag_vectors(movies: DataFrame, tags: DataFrame, min_df: int = 2, max_features: int | None = None) -> DataFrame:
    """TF-IDF of every movie's tag document (frequent normalised tags); the
    term counts come from the tag rows, every catalog movie is a document."""
    tf = X.tag_term_counts(frequent_tags(tags, 2))
    n_docs = movies.agg(F.count(F.lit(1)).alias("n_docs"))
    return X.tfidf_from_counts(tf, n_docs, min_df=min_df, max_features=max_features)


def similar_by_tags(movies: DataFrame, tags: DataFrame, k: int = 10) -> DataFrame:
    """R2: cosine over tag TF-IDF (min_df 2); movies without
    tag terms have no list; only similarities > 0."""
    v = tag_vectors(movies, tags)
    return _as_list(pruned_topk(v, v, k), "seed", k)


def content_vectors(movies: DataFrame, tags: DataFrame, min_tag_freq: int = 2) -> DataFrame:
    """X5 stack of every movie; ``tags`` are raw rows or (movieId, combined_tags)."""
    if "combined_tags" in tags.columns:
        meta = enrich_movies(movies).join(tags.select("movieId", "combined_tags"), "movieId", "left").fillna("", ["combined_tags"])
        return X.feature_stack(meta)
    return X.feature_stack(enrich_movies(movies), tag_counts=X.tag_term_counts(frequent_tags(tags, min_tag_freq)))


def similar_by_content(movies: DataFrame, tags: DataFrame, k: int = 10) -> DataFrame:
    """Cosine over the weighted genre || tag || title stack, clamped at 0,
    zero-similarity rows may fill the list."""
    v = written(content_vectors(movies, tags), "content-vectors")
    top = pruned_topk(v, v, k, stored=True)
    seeds = v.select(F.col("id").alias("sid")).distinct()
    padded = pad_with_zero(top, seeds, movies.select(F.col("movieId").alias("iid")), k)
    return _as_list(padded, "seed", k)


def user_profiles(ratings: DataFrame, item_vecs: DataFrame, min_rating: float = 3.0) -> DataFrame:
    """R4 profile: sum over the user's ratings >= 3.0 of (r - 2.5) * item vector
    (aggregated per (user, term), partial aggregation before the shuffle)."""
    r = ratings.where(F.col("rating") >= F.lit(min_rating)).select("userId", "movieId", "rating")
    j = r.join(item_vecs.withColumnRenamed("id", "movieId"), "movieId")
    return (j.groupBy("userId", "term").agg(F.sum((F.col("rating") - 2.5) * F.col("w")).alias("w"))
            .select(F.col("userId").alias("id"), "term", "w"))


def profile_candidates(ratings: DataFrame, movies: DataFrame, tags: DataFrame, k: int = 10,
                       item_vecs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(sid) of the users with a profile, and (sid, iid, sim) among which are
    the k unrated items most like each of them (similarity above 0), written."""
    iv = written(item_vecs if item_vecs is not None else content_vectors(movies, tags), "content-vectors")
    prof = written(user_profiles(ratings, iv), "profiles")
    seen = ratings.select(F.col("userId").alias("sid"), F.col("movieId").alias("iid"))
    found = candidates(prof, iv, k, exclude=seen, exclude_self=False, stored=True)
    return prof.select(F.col("id").alias("sid")).distinct(), found.where(F.col("iid").isNotNull()).select("sid", "iid", "sim")


def recommend_from_profile(ratings: DataFrame, movies: DataFrame, tags: DataFrame, k: int = 10,
                           item_vecs: DataFrame | None = None, found: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Cosine between the user profile and every item; all rated items
    excluded; zero-similarity rows may fill; users without a qualifying rating
    get no rows. ``found``: the ``profile_candidates`` of these arguments and the
    same or a larger k."""
    seeds, found = profile_candidates(ratings, movies, tags, k, item_vecs) if found is None else found
    seen = ratings.select(F.col("userId").alias("sid"), F.col("movieId").alias("iid"))
    top = top_k_per_group(found, "sid", k, [F.col("sim").desc(), F.col("iid").asc()])
    padded = pad_with_zero(top, seeds, movies.select(F.col("movieId").alias("iid")), k, exclude=seen,
                           exclude_self=False)
    return _as_list(padded, "userId", k)


def item_item_cf(ratings: DataFrame, k: int = 10) -> DataFrame:
    """Cosine between item rating columns (users as terms), clamped at 0,
    zero rows fill from the rated-item universe."""
    v = written(_vec(ratings, "movieId", "userId", "rating"), "item-vectors")
    top = pruned_topk(v, v, k, stored=True)
    seeds = v.select(F.col("id").alias("sid")).distinct()
    padded = pad_with_zero(top, seeds, seeds.select(F.col("sid").alias("iid")), k)
    return _as_list(padded, "seed", k)


def user_neighbours(ratings: DataFrame, n_neighbors: int = 30) -> DataFrame:
    """The n most similar other users with similarity > 0: (userId, nbr, sim)."""
    v = _vec(ratings, "userId", "movieId", "rating")
    nb = pruned_topk(v, v, n_neighbors)
    return _round(nb).select(F.col("sid").alias("userId"), F.col("iid").alias("nbr"), "sim")


def user_user_cf(ratings: DataFrame, k: int = 10, n_neighbors: int = 30) -> DataFrame:
    """score = sum(sim * rating) / sum(sim) over the neighbours who rated
    the movie; seen movies removed; top-k by score, then movieId."""
    nb = user_neighbours(ratings, n_neighbors)
    nr = ratings.select(F.col("userId").alias("nbr"), "movieId", "rating")
    cand = nb.join(nr, "nbr").join(ratings.select("userId", "movieId"), ["userId", "movieId"], "left_anti")
    pred = cand.groupBy("userId", "movieId").agg(
        (F.sum(F.col("sim") * F.col("rating")) / F.sum("sim")).alias("score"))
    pred = pred.withColumn("score", F.round("score", SIM_DP))
    return top_k_per_group(pred, "userId", k, [F.col("score").desc(), F.col("movieId").asc()]).select(
        "userId", "rank", "movieId", "score")


def embedding_neighbours(emb: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """R15 on a dense embedding table: cosine top-k without the seed (any sign)."""
    top = cosine_topk(emb.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")), k)
    r = top_k_per_group(_round(top), "sid", k, [F.col("sim").desc(), F.col("iid").asc()])
    return r.select(F.col("sid").alias("seed"), "rank", F.col("iid").alias("neighbour"), "sim")


__all__ = ["similar_by_genre", "similar_by_tags", "similar_by_content", "recommend_from_profile",
           "item_item_cf", "user_user_cf", "user_neighbours", "embedding_neighbours", "l2_normalize"]
