"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded first: lower case, accents and look-alike letters of other
scripts to plain ones, digits and signs that stand for letters to those letters
(i, l, 1 and | are one), everything else blank. The lexicon holds whole words
and word beginnings with a weight each, and exception phrases; a lexicon match
inside an exception phrase does not count. The sum of the weights, also divided
by the length of the text, goes through a logistic curve.

Lexicon, exceptions and curve are learned from labelled documents: a whole word
or beginning enters if it is far commoner in toxic documents than in clean
ones (its weight is the log ratio), those with most evidence first, then such as
mark toxic documents that these leave unmatched; a two-word phrase around a match becomes an
exception if it is found in clean documents and hardly ever in toxic ones. The
fit draws ``SAMPLE`` documents of each label by hash or so; all rows are scored
over their whole texts. A pattern that could be common in toxic documents by
chance, many being tried, is left out (``MIN_EVIDENCE``).

Defined results: one row out per row in. Null and empty texts get the score of
a text without matches. Without labels of both kinds every score is 0. A
document with several label rows counts as toxic if one of them says so; null
labels say nothing. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import if_small, written

SAMPLE = 3000              # labelled documents of each label that the fit draws
THRESHOLD = 0.3
PREFIX = range(4, 9)       # lengths of word beginnings
MIN_RATIO = 20.0           # of a pattern's share of toxic documents to its share of clean ones
MIN_EVIDENCE = 10.0        # log likelihood ratio that a pattern's share of toxic documents is not chance
ROUNDS = 6                 # each looks at the toxic documents that the lexicon so far does not match
PART_OF_BEST = 0.2         # of the best pattern's evidence that others of its round must have
MIN_EXCEPTION_DOCS = 3

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "з": "e", "и": "u", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "һ": "h", "ӏ": "i",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u",
    "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ø": "o", "ł": "l", "đ": "d", "ß": "s",
}
# Digits and signs that stand for letters; i and l are one letter here.
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "|": "i", "l": "i"}


class Folding(dict):
    """Translation table, filled character by character on first use."""

    def __missing__(self, code: int) -> str:
        out = ""
        for c in unicodedata.normalize("NFKD", chr(code)).lower():
            if unicodedata.combining(c):
                continue
            c = HOMOGLYPHS.get(c, c)
            out += SUBSTITUTIONS.get(c, c if c.isalpha() else " ")
        if not out:                            # a bare accent or an invisible joiner vanishes
            out = "" if unicodedata.category(chr(code)) in ("Mn", "Cf") else " "
        if unicodedata.category(chr(code)) == "Cf":
            out = ""
        self[code] = out
        return out


FOLDING = Folding()


def fold(text: str | None) -> str:
    return f" {(text or '').translate(FOLDING)} "


def _patterns(folded: str) -> set[str]:
    """Whole words (blank on both sides) and beginnings (blank before)."""
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        for k in PREFIX:
            if k <= len(w):
                out.add(f" {w[:k]}")
    return out


class Matcher:
    """The automaton of lexicon and exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions: list[str]):
        self.auto = ahocorasick.Automaton()
        for p in exceptions:
            self.auto.add_word(p, (len(p), 0.0, True))
        for p, w in lexicon.items():
            self.auto.add_word(p, (len(p), w, False))
        self.empty = not len(self.auto)
        if not self.empty:
            self.auto.make_automaton()

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """Lexicon matches outside exception phrases: start, end, weight; of
        those that begin at one place the heaviest counts."""
        if self.empty:
            return []
        found, excused = {}, []
        for last, (size, weight, exception) in self.auto.iter(folded):
            start = last + 1 - size
            if exception:
                excused.append((start, last + 1))
            elif weight > found.get(start, (0, 0.0))[1]:
                found[start] = (last + 1, weight)
        excused.sort()
        starts, reach = [s for s, _ in excused], list(accumulate((e for _, e in excused), max))     # how far exceptions up to each one reach
        out = []
        for a, (b, w) in found.items():
            i = bisect_right(starts, a)
            if not i or reach[i - 1] < b:
                out.append((a, b, w))
        return out


def _word_before(folded: str, at: int) -> list[str]:
    """The last word that ends before ``at``, if any."""
    while at and folded[at - 1] == " ":
        at -= 1
    return [folded[folded.rfind(" ", 0, at) + 1:at]] if at else []


def _words_from(folded: str, at: int, n: int) -> list[str]:
    """The first n words from ``at`` on; a folded text ends in a blank."""
    out = []
    while len(out) < n:
        while at < len(folded) and folded[at] == " ":
            at += 1
        if at == len(folded):
            break
        end = folded.find(" ", at)
        out.append(folded[at:end])
        at = end
    return out


def _count_patterns(lexicon):
    """Documents of each label by pattern, and all of them under the empty
    pattern; toxic documents that the lexicon so far matches are left out."""
    def run(batches):
        matcher = Matcher(lexicon.value, [])
        for batch in batches:
            seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                folded = fold(text)
                if not (toxic and matcher.matches(folded)):
                    seen[bool(toxic)].update(_patterns(folded) | {""})
            yield _pattern_rows(seen)
    return run


def _pattern_rows(seen: dict[bool, Counter]) -> pa.RecordBatch:
    keys = list(seen[True] | seen[False])
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.string()), pa.array([seen[True][k] for k in keys], pa.int64()),
         pa.array([seen[False][k] for k in keys], pa.int64())], names=["pattern", "toxic_docs", "clean_docs"])


def features(matches, folded: str) -> tuple[float, float]:
    total = sum(w for _, _, w in matches)
    return math.log1p(total), math.log1p(1000.0 * total / len(folded))


def _contexts(lexicon):
    """Two-word phrases around the matches of labelled documents."""
    def run(batches):
        matcher = Matcher(lexicon.value, [])
        for batch in batches:
            seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                folded, here = fold(text), set()
                for a, _, _ in matcher.matches(folded):
                    words = _words_from(folded, a, 2)
                    for phrase in ([*_word_before(folded, a), *words[:1]], words):
                        if len(phrase) == 2:
                            here.add(f" {' '.join(phrase)} ")
                seen[bool(toxic)].update(here)
            yield _pattern_rows(seen)
    return run


def _features(model):
    def run(batches):
        matcher = Matcher(*model.value)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                folded = fold(text)
                rows.append(features(matcher.matches(folded), folded))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([r[0] for r in rows], pa.float64()),
                                              pa.array([r[1] for r in rows], pa.float64())], names=["toxic", "x1", "x2"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Coefficients (intercept first) by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    penalty = np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - penalty @ b
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty + 1e-6 * np.eye(len(b))
        b = b + np.linalg.solve(hessian, gradient)
    return b


def _sum_by_pattern(rows: DataFrame) -> DataFrame:
    return rows.groupBy("pattern").agg(F.sum("toxic_docs").alias("toxic_docs"), F.sum("clean_docs").alias("clean_docs"))


def _new_patterns(counts: DataFrame) -> dict[str, float]:
    """The patterns with most evidence among the documents still unexplained,
    and their weights."""
    total = counts.where("pattern = ''").first()
    if total is None or not total["toxic_docs"] or not total["clean_docs"]:
        return {}
    n_toxic, n_clean = total["toxic_docs"], total["clean_docs"]
    base = n_toxic / (n_toxic + n_clean)
    t, c = F.col("toxic_docs").cast("double"), F.col("clean_docs").cast("double")
    evidence = t * F.log(t / (t + c) / base) + F.when(c > 0, c * F.log(c / (t + c) / (1 - base))).otherwise(0.0)
    ratio = ((t + 0.5) / (n_toxic + 1)) / ((c + 0.5) / (n_clean + 1))
    best = (counts.where((t > 0) & (F.col("pattern") != "")).withColumn("ratio", ratio).withColumn("evidence", evidence)
            .where((F.col("ratio") >= MIN_RATIO) & (F.col("evidence") >= MIN_EVIDENCE))
            .orderBy(F.desc("toxic_docs"), F.length("pattern"), "pattern").collect())          # of the sample's words
    out: dict[str, float] = {}
    least = PART_OF_BEST * max((r["evidence"] for r in best), default=0.0)
    for r in best:                              # the commonest first; longer forms of what is in add nothing
        if r["evidence"] >= least and not any(r["pattern"][:k] in out for k in range(2, len(r["pattern"]))):
            out[r["pattern"]] = math.log(r["ratio"])
    return out


def fit(labelled: DataFrame, n_toxic: int, n_clean: int, share_toxic: float, exceptions=()):
    """(lexicon, exceptions, coefficients) from ``labelled(text, toxic)`` of
    that many rows; share_toxic is the share of toxic rows where they were drawn."""
    spark = labelled.sparkSession
    schema = "pattern string, toxic_docs bigint, clean_docs bigint"
    lexicon: dict[str, float] = {}
    for _ in range(ROUNDS):
        new = _new_patterns(written(_sum_by_pattern(
            labelled.mapInArrow(_count_patterns(spark.sparkContext.broadcast(lexicon)), schema)), "toxicity-patterns"))
        if not new:
            break
        lexicon.update(new)
    found = _sum_by_pattern(labelled.mapInArrow(_contexts(spark.sparkContext.broadcast(lexicon)), schema))
    learned = [r["pattern"] for r in found.where(
        (F.col("clean_docs") >= MIN_EXCEPTION_DOCS) & (F.col("clean_docs") / n_clean > MIN_RATIO * F.col("toxic_docs") / n_toxic))
        .orderBy(F.desc("clean_docs"), "pattern").collect()]                                # phrases of the sample
    phrases = learned + [fold(p) for p in exceptions]
    model = spark.sparkContext.broadcast((lexicon, phrases))
    sample = labelled.mapInArrow(_features(model), "toxic boolean, x1 double, x2 double").toPandas()    # 2 * SAMPLE rows or so
    y = sample["toxic"].to_numpy().astype(float)
    weight = np.where(y > 0, share_toxic / max(y.mean(), 1e-9), (1 - share_toxic) / max(1 - y.mean(), 1e-9))
    return lexicon, phrases, _logistic(sample[["x1", "x2"]].to_numpy(), y, weight)


def _score(model, threshold: float):
    def run(batches):
        lexicon, phrases, b = model.value
        matcher = Matcher(lexicon, phrases)
        for batch in batches:
            scores, hits = [], []
            for text in batch.column("text").to_pylist():
                folded = fold(text)
                found = matcher.matches(folded)
                x1, x2 = features(found, folded)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, b[0] + b[1] * x1 + b[2] * x2)))))
                hits.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(hits, pa.int64())],
                names=["doc_id", "held_out", "score", "predicted", "n_hits"])
    return run


def held_out(doc_id):
    """Fold of a document: crc32 of its id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD, exceptions=()) -> DataFrame:
    """doc_id, held_out, score, predicted and n_hits of every row of ``docs``,
    learned from the ``labels`` that are not held out."""
    spark = docs.sparkSession
    known = (labels.select(F.col("doc_id").alias("label_id"), "toxic").where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .where(~held_out(F.col("doc_id"))).groupBy("label_id").agg((F.max("toxic") == 1).alias("toxic")))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = docs.select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    out = f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double, predicted int, n_hits bigint"
    plain = rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0).cast("bigint").alias("n_hits"))
    if len(sizes) < 2:
        return plain
    bucket = F.pmod(F.xxhash64("label_id", F.lit("fit")), F.lit(1 << 30)).cast("double")
    size = F.when(F.col("toxic"), float(sizes[True])).otherwise(float(sizes[False]))
    drawn = if_small(known.where(bucket * size < float(sample << 30)), "toxicity-labels")
    labelled = written(rows.join(drawn, F.col("doc_id") == F.col("label_id")).select("text", "toxic")
                       .repartition(spark.sparkContext.defaultParallelism), "toxicity-sample")
    found = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(found) < 2:
        return plain
    model = spark.sparkContext.broadcast(fit(labelled, found[True], found[False], sizes[True] / sum(sizes.values()), exceptions))
    return rows.select("doc_id", "held_out", "text").mapInArrow(_score(model, threshold), out)
