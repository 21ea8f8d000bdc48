"""Text and categorical feature spaces in long form.

A feature space is a table ``(id, term, w)``.  TF-IDF follows the public
semantics of the usual vectoriser parameters: tokens are lower-cased runs of
>= 2 word characters, stop words removed, 1-2-grams built *after* stop-word
removal (so bigrams cross tag borders), sublinear tf ``1 + ln(tf)``, smooth
idf ``ln((1 + n) / (1 + df)) + 1``, rows L2-normalised, ``min_df`` on document
frequency and ``max_features`` on corpus term frequency (ties by term).

Everything is explode + aggregate: term counts are partially aggregated per
partition before the shuffle on (doc, term); document frequencies are a
second aggregate on term.  No document is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.ranking import global_rank
from cinelake.functions.stopwords import ENGLISH_STOP_WORDS
from cinelake.functions.text import NO_GENRE, tokens
from cinelake.session import written

BROADCAST_TERMS = 200_000          # of at most a few words each


def token_array(text, stop_words: bool = True):
    t = tokens(text)
    if stop_words:
        # a literal IN list is planned as a hash-set lookup (InSet)
        t = F.filter(t, lambda x: ~x.isin(*ENGLISH_STOP_WORDS))
    return t


def ngram_array(toks, n_max: int = 2):
    """Unigrams followed by contiguous bigrams of the (filtered) token array."""
    if n_max < 2:
        return toks
    nxt = F.slice(toks, 2, F.greatest(F.size(toks) - 1, F.lit(1)))
    bigrams = F.filter(F.zip_with(toks, nxt, lambda a, b: F.concat(a, F.lit(" "), b)), lambda x: x.isNotNull())
    return F.concat(toks, bigrams)


def term_counts(docs: DataFrame, id_col: str, text_col: str, n_max: int = 2,
                stop_words: bool = True) -> DataFrame:
    """(id, term, tf) for every document. The texts are hashed by id, and their
    terms are counted where they lie: no term of a single document is shuffled."""
    whole = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias(text_col)).repartition("id")
    terms = whole.select("id", F.explode(ngram_array(token_array(F.col(text_col), stop_words), n_max)).alias("term"))
    return terms.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(tf: DataFrame, min_df: int = 1, max_features: int | None = None) -> DataFrame:
    """(term, df, ctf) of ``tf`` rows; ``min_df`` on document frequency and X4:
    the ``max_features`` terms with the largest corpus count, ties by term, as
    a distributed global rank (no driver-side sort of the vocabulary)."""
    vocab = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ctf"))
    if min_df > 1:
        vocab = vocab.where(F.col("df") >= min_df)
    if max_features is not None:
        vocab = global_rank(vocab, [F.col("ctf").desc(), F.col("term").asc()], rank_col="_r") \
            .where(F.col("_r") <= max_features).drop("_r")
    return vocab


def tfidf(docs: DataFrame, id_col: str, text_col: str, min_df: int = 1, max_features: int | None = None,
          n_max: int = 2, stop_words: bool = True, sublinear: bool = True) -> DataFrame:
    """L2-normalised TF-IDF weights ``(id, term, w)``."""
    tf = term_counts(docs, id_col, text_col, n_max, stop_words)
    n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    return tfidf_from_counts(tf, n_docs, min_df, max_features, sublinear)


def tfidf_from_counts(tf: DataFrame, n_docs: DataFrame, min_df: int = 1, max_features: int | None = None,
                      sublinear: bool = True) -> DataFrame:
    """TF-IDF from ``(id, term, tf)`` counts and a one-row ``(n_docs)`` frame
    (documents without terms count in n_docs).  A vocabulary of at most
    ``BROADCAST_TERMS`` terms (counted) is sent to all tasks, a larger one joined
    by shuffle; the weights are hashed by id once, for norms and result."""
    tf = written(tf, "term-counts")     # the vocabulary reads its columns, the weights all: computed once
    vocab = vocabulary(tf, min_df, max_features)
    idf = vocab.crossJoin(F.broadcast(n_docs)).select(
        "term", (F.log((F.lit(1.0) + F.col("n_docs")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf"))
    idf = written(idf, "idf")
    idf = F.broadcast(idf) if idf.count() <= BROADCAST_TERMS else idf
    tfw = (F.lit(1.0) + F.log(F.col("tf"))) if sublinear else F.col("tf").cast("double")
    w = tf.join(idf, "term").select("id", "term", (tfw * F.col("idf")).alias("w"))
    w = w.repartition("id")             # both branches below read this one exchange
    norm = w.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, "id").select("id", "term", (F.col("w") / F.col("norm")).alias("w"))


def tag_term_counts(tags: DataFrame, n_max: int = 2) -> DataFrame:
    """``(id=movieId, term, tf)`` of each movie's tag document -- the blank
    join of its normalised tags in (userId, ts, tag) order -- computed from the
    tag rows, without building the document.

    The blank separator ends every token, so the document's tokens are the
    tags' tokens in order: unigrams and in-tag bigrams come from each row
    alone, and the only bigram spanning two rows joins the first token of a
    tag to the last token of the previous tag that has any token.  That
    previous tag is a distributed lag (``lag_within``), so a movie carrying a
    large share of all tags is spread over many tasks instead of being
    collected into one row.  ``tags``: normalised rows (movieId, userId, ts,
    tag_clean)."""
    from cinelake.functions.ranking import lag_within
    t = tags.select("movieId", "userId", "ts", "tag_clean", token_array(F.col("tag_clean")).alias("toks"))
    t = t.where(F.size("toks") > 0).withColumn("_last", F.element_at("toks", -1))
    terms = t.select(F.col("movieId").alias("id"), F.explode(ngram_array(F.col("toks"), n_max)).alias("term"))
    if n_max >= 2:
        t = lag_within(t, "movieId", [F.col("userId"), F.col("ts"), F.col("tag_clean")], "_last", out="_prev")
        cross = t.where(F.col("_prev").isNotNull()).select(
            F.col("movieId").alias("id"), F.concat(F.col("_prev"), F.lit(" "), F.element_at("toks", 1)).alias("term"))
        terms = terms.unionByName(cross)
    return terms.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))


def genre_multihot(movies: DataFrame) -> DataFrame:
    """Binary genre vector, vocabulary = raw pipe parts (case kept, null
    genres count as the sentinel)."""
    g = F.array_distinct(F.split(F.coalesce(F.col("genres"), F.lit(NO_GENRE)), r"\|"))
    return movies.select(F.col("movieId").alias("id"), F.explode(g).alias("term")).select(
        "id", "term", F.lit(1.0).alias("w"))


def feature_stack(meta: DataFrame, genre_weight: float = 1.0, tag_weight: float = 1.5,
                  title_weight: float = 0.8, max_tag_features: int | None = None,
                  max_title_features: int | None = None, tag_counts: DataFrame | None = None) -> DataFrame:
    """X5 (the weights are fixed values of the public model): weighted stack genre || tag TF-IDF || title TF-IDF as one long table
    with a space prefix on the term.  ``meta``: one row per movie with genres
    and clean_title, plus combined_tags unless the tag documents' term counts
    are given as ``tag_counts`` (``tag_term_counts``)."""
    g = genre_multihot(meta).select("id", F.concat(F.lit("g:"), "term").alias("term"),
                                    (F.col("w") * genre_weight).alias("w"))
    if tag_counts is None:
        tt = tfidf(meta, "movieId", "combined_tags", 1, max_tag_features)
    else:
        tt = tfidf_from_counts(tag_counts, meta.agg(F.count(F.lit(1)).alias("n_docs")), 1, max_tag_features)
    t = tt.select("id", F.concat(F.lit("t:"), "term").alias("term"), (F.col("w") * tag_weight).alias("w"))
    n = tfidf(meta, "movieId", "clean_title", 1, max_title_features).select(
        "id", F.concat(F.lit("n:"), "term").alias("term"), (F.col("w") * title_weight).alias("w"))
    return g.unionByName(t).unionByName(n)
