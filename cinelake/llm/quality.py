"""Quality rules by cross-document line frequency.

Every text is measured alone (words, symbols, repeated lines and 8-word
windows); documents that fail these base rules are rejected. Then normalised
lines (words in lower case, white space collapsed) are hashed (XXH64), and for every
host (``source``) the distinct documents that hold a line are counted. Lines on
more than ``max_share`` of the host's documents, and on at least ``min_docs``,
are removed; a document that keeps less than ``min_left`` of its words is
rejected as depleted. Documents with equal text count once for a line, so
copies of one document do not turn it into boilerplate (the near-duplicate
stage deals with those).

Defined results: one row out per row in. A null or empty text has no words and
fails the base rules. Null hosts form one host. Repeated rows get equal
results. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cinelake.llm import bytekernel as bk
from cinelake.llm.common import if_small, with_row_key, written

MIN_WORDS = 20           # base rule: fewer words fail
MAX_REPEAT_PCT = 30      # base rule: percentage of words in repeated windows
WINDOW = 8
MAX_SHARE = 0.10         # of a host's distinct documents that may hold a line
MIN_DOCS = 10            # a line on fewer documents is never boilerplate
MIN_LEFT = 0.30          # share of its words that a document must keep

SYMBOLS = bk.byte_set(lambda b: chr(b) in "#*$%&|<>")
_NEWLINE = 0x0A
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _later_equal(keys: np.ndarray) -> np.ndarray:
    """Marks the elements that equal an earlier one."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    sorted_keys = keys[order]
    same[order[1:][sorted_keys[1:] == sorted_keys[:-1]]] = True
    return same


def _codes(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Numbers of the values ``data[edges[i]:edges[i + 1]]``, equal exactly where
    their bytes are."""
    values = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)])
    return values.dictionary_encode().indices.to_numpy()


def _repeated(words: np.ndarray, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Marks the windows (``WINDOW`` words from each of ``at`` on) that occur
    twice or more in their text. Windows of one hash are compared word by word;
    a text in which unequal ones share a hash is counted over again."""
    keys = bk.window_hashes(bk.mix(words.astype(np.uint64) + np.uint64(1)), WINDOW)[at] ^ bk.mix(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys)
    same = np.flatnonzero(np.diff(keys[order]) == 0)
    if (doc[order[same]] != doc[order[same + 1]]).any():   # texts whose windows share a hash: apart, by text
        order = np.lexsort((doc, keys))
        same = np.flatnonzero((np.diff(keys[order]) == 0) & (np.diff(doc[order]) == 0))
    one, two = order[same], order[same + 1]
    flag = np.zeros(len(at), bool)
    flag[one] = flag[two] = True
    equal = np.ones(len(one), bool)
    for j in range(WINDOW):
        equal &= words[at[one] + j] == words[at[two] + j]
    for d in np.unique(doc[one[~equal]]).tolist():
        mine = np.flatnonzero(doc == d)
        windows = [tuple(words[a:a + WINDOW].tolist()) for a in at[mine].tolist()]
        counts = Counter(windows)
        flag[mine] = [counts[w] > 1 for w in windows]
    return flag


def measure(data: np.ndarray, docs: np.ndarray):
    """Base measures of each text, and hash, words and text of its lines."""
    n = len(docs) - 1
    ws = bk.find_words(data, docs, bk.NOT_SPACE)
    in_word = bk.NOT_SPACE[data]
    out = {"n_words": ws.counts.astype(np.int64),
           "word_chars": bk.sums(in_word & ((data & 0xC0) != 0x80), docs),
           "n_symbols": bk.sums(SYMBOLS[data], docs)}

    # lines: cut at newlines and at the ends of texts
    breaks = np.flatnonzero(data == _NEWLINE)
    owner = np.searchsorted(docs, breaks, "right") - 1
    line_doc = np.sort(np.concatenate([np.arange(n), owner]), kind="stable")
    starts = np.sort(np.concatenate([docs[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([docs[1:], breaks]), kind="stable")
    lo, hi = np.searchsorted(ws.starts, starts), np.searchsorted(ws.starts, ends)
    full = np.flatnonzero(hi > lo)
    text = data != _NEWLINE                                 # without newlines the lines stand one behind the other
    before = np.concatenate([[0], np.cumsum(text)])
    code = _codes(data[text], np.append(before[starts], before[-1]))[full]
    line_doc, lo, hi = line_doc[full], lo[full], hi[full]
    key = line_doc * (np.int64(len(starts)) + 1) + code
    out["n_dup_lines"] = np.bincount(line_doc[_later_equal(key)], minlength=n).astype(np.int64)

    # words as they are, one blank behind each
    joined, first, last = bk.joined_words(ws, np.arange(256, dtype=np.uint8))
    raw = bk.LOWER[joined].tobytes()
    line_hash = np.array([xxh64_intdigest(raw[a:b]) for a, b in zip(first[lo].tolist(), last[hi - 1].tolist())], np.uint64)
    repeat = np.zeros(n, np.int64)
    at = bk.whole_windows(ws.first, WINDOW)
    if len(at):
        words = _codes(joined, np.append(first, len(joined)))
        hit = at[_repeated(words, at, np.repeat(np.arange(n), ws.counts)[at])]
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + WINDOW, -1)
        repeat = bk.sums(np.cumsum(cover[:-1]) > 0, ws.first)
    out["n_repeat_words"] = repeat
    return out, line_doc, line_hash.view(np.int64), (hi - lo).astype(np.int64)


def _measure_batches(batches):
    for batch in batches:
        data, offsets = bk.text_buffers(batch.column("text"))
        for i, j in bk.doc_chunks(offsets):
            docs = offsets[i:j + 1] - offsets[i]
            out, line_doc, line_hash, line_words = measure(data[offsets[i]:offsets[j]], docs)
            per_doc = np.bincount(line_doc, minlength=j - i)
            cols = [batch.column(c).slice(i, j - i) for c in ("doc_id", "source", "k1", "k2")]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(out[m]) for m in _MEASURES]
                + [bk.list_array(line_hash, per_doc), bk.list_array(line_words, per_doc)],
                names=["doc_id", "source", "k1", "k2", *_MEASURES, "lines", "line_words"])


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, source, k1, k2, the base measures and the arrays ``lines`` (hashes
    of normalised lines with a word) and ``line_words``."""
    src = with_row_key(docs.select("doc_id", "text", "source"), "doc_id", "text", "source")
    kinds = dict(src.dtypes)
    schema = (f"doc_id {kinds['doc_id']}, source {kinds['source']}, k1 bigint, k2 bigint, "
              + ", ".join(f"{m} bigint" for m in _MEASURES) + ", lines array<bigint>, line_words array<bigint>")
    return src.select("doc_id", "source", "k1", "k2", "text").mapInArrow(bk.releasing(_measure_batches), schema)


def frequent_lines(measured: DataFrame, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS) -> DataFrame:
    """source, hashes: for each host the lines above the limits. A line on a
    share s of the documents costs s documents' lines, so a host has at most
    (mean lines of a document) / max_share of them."""
    text = F.xxhash64(F.lit(7), "lines", "n_words", "word_chars")
    lines = measured.select("source", text.alias("content"), F.explode(F.array_distinct("lines")).alias("line"))
    held = lines.distinct().groupBy("source", "line").agg(F.count(F.lit(1)).alias("n_docs"))
    hosts = measured.select("source", text.alias("content")).distinct().groupBy("source").agg(F.count(F.lit(1)).alias("n_host"))
    hosts = if_small(hosts.select(F.col("source").alias("h_source"), "n_host"), "quality-hosts")
    cut = held.where(F.col("n_docs") >= min_docs).join(hosts, F.col("source").eqNullSafe(F.col("h_source"))).where(
        F.col("n_docs") > F.lit(max_share) * F.col("n_host"))
    return cut.groupBy("source").agg(F.collect_list("line").alias("hashes"))


def judge(docs: DataFrame, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, min_left: float = MIN_LEFT,
          min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT) -> DataFrame:
    """One row per document: the base measures, ``base_failed``,
    ``n_boilerplate_words`` (words in lines above the limits) and ``kept``."""
    m = written(measures(docs), "quality-measures")
    frequent = if_small(frequent_lines(m, max_share, min_docs).select(F.col("source").alias("f_source"), "hashes"),
                        "quality-lines")
    gone = F.aggregate(
        F.zip_with("lines", "line_words", lambda l, w: F.when(F.array_contains("hashes", l), w).otherwise(F.lit(0).cast("bigint"))),
        F.lit(0).cast("bigint"), lambda a, x: a + x)
    base_failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct)
    out = (m.join(frequent, F.col("source").eqNullSafe(F.col("f_source")), "left")
           .withColumn("n_boilerplate_words", F.when(F.col("hashes").isNull(), F.lit(0).cast("bigint")).otherwise(gone))
           .withColumn("base_failed", base_failed))
    left = F.col("n_words") - F.col("n_boilerplate_words")
    return out.withColumn("kept", ~F.col("base_failed") & (left >= F.lit(min_left) * F.col("n_words"))).select(
        "doc_id", *_MEASURES, "base_failed", "kept", "n_boilerplate_words", "k1", "k2")


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """Filter stage: the rows of ``docs`` that the rules keep, unchanged."""
    bad = if_small(judge(docs, **limits).where(~F.col("kept")).select("k1", "k2").distinct(), "quality-rejected")
    names = docs.columns
    keyed = docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in names])).select(
        "_row", "doc_id", "text", "source")
    return (with_row_key(keyed, "doc_id", "text", "source").join(bad, ["k1", "k2"], "left_anti")
            .select(*[F.col("_row").getField(c).alias(c) for c in names]))
