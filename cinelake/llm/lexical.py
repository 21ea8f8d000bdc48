"""Ranked lexical search: hybrid of term-at-a-time and document-at-a-time.

``build_index`` scans whole texts once. Every run of documents of about
``SHARD`` bytes becomes one shard of the inverted index, a row of a written
table: its documents in ascending doc_id, and for each term the positions and
frequencies of the documents that hold it. Counts over all documents (N, L, df)
are sums over the shards.

``search`` meets every shard with the queries. In a shard, a query's short
lists are worked off term at a time: their scores are summed into materialised
accumulators, which from then on are one more iterator with known bounds. The
long lists and that iterator are walked document at a time, in blocks of
``BLOCK`` documents: a block whose summed bounds stay below the k-th best score
so far is skipped; in the others only lists that could lift a document over that
score propose candidates, the rest are looked up for those that still can reach
it. Shards return their best k, of which the best k of all remain. All scores
are integers, so nothing depends on the order of sums.

Defined results: terms are maximal runs of ASCII letters and digits and of all
characters beyond ASCII, A-Z in lower case. A null or empty text has no terms; a
document without terms is never returned, a query without known terms returns
nothing. Rows with equal doc_ids are documents of their own; a null doc_id comes
last among equal scores. Equal rows of ``items`` count once, rows with equal
item_id and different texts are one query with all their terms; a null item_id
is a query like others. An empty table on either side gives no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm import bytekernel as bk
from cinelake.llm.common import written

SHARD = 1 << 24                # bytes of the texts of a shard, or one longer text
BLOCK = 512                    # documents whose bounds are held together
SHORT = 1 / 64                 # lists of at most this share of a shard's documents are summed term at a time
MAX_TERMS = 200_000            # distinct query terms up to which the index holds those alone; beyond, it holds all terms
QUERIES = 256                  # queries of one packed row
PACKED_BYTES = 1 << 23         # packed queries up to this size are sent to every task; beyond, they are joined by blocks

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_INDEX = ("n_docs bigint, n_terms bigint, doc_ids array<bigint>, sizes array<bigint>, terms array<string>, "
          "bounds array<int>, docs array<int>, tfs array<int>")


def query_terms(items: DataFrame) -> DataFrame:
    """item_id, term, qtf: how often the term occurs in the item's texts."""
    words = F.regexp_extract_all(F.translate("text", _UPPER, _UPPER.lower()), F.lit(TERM), F.lit(0))
    return (items.select("item_id", "text").distinct().select("item_id", F.explode(words).alias("term"))
            .groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("qtf")))


def _shards(terms: list[str] | None, shard_bytes: int):
    wanted = None if terms is None else pa.array([t.encode() + b" " for t in terms], pa.binary())

    def run(batches):
        for batch in batches:
            data, offsets = bk.text_buffers(batch.column("text"))
            ids = batch.column("doc_id")
            for i, j in bk.doc_chunks(offsets, shard_bytes):
                yield _shard(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], ids.slice(i, j - i), wanted)
    return run


def _shard(data: np.ndarray, offsets: np.ndarray, ids: pa.Array, wanted: pa.Array | None) -> pa.RecordBatch:
    ws = bk.find_words(data, offsets, bk.LETTER_DIGIT)
    joined, starts, _ = bk.joined_words(ws, bk.LOWER)
    edges = np.append(starts, len(joined)).astype(np.int32)        # each word with the blank behind it
    coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(joined)]).dictionary_encode()
    named = coded.dictionary
    at = (np.arange(len(named)) if wanted is None
          else pc.fill_null(pc.index_in(named, value_set=wanted), -1).to_numpy(zero_copy_only=False))
    order = pc.sort_indices(pa.table({"d": ids}), sort_keys=[("d", "ascending")], null_placement="at_end").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    term = at[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
    held = np.flatnonzero(term >= 0)
    doc = place[np.repeat(np.arange(len(ids)), ws.counts)[held]]
    key, tf = np.unique(term[held].astype(np.int64) * len(ids) + doc, return_counts=True)
    term, doc = key // len(ids), key % len(ids)
    present, first = np.unique(term, return_index=True)
    names = (named if wanted is None else wanted).take(pa.array(present)).to_pylist()
    one = lambda x, kind: bk.list_array(pa.array(x, kind), np.array([len(x)]))
    return pa.RecordBatch.from_arrays(
        [pa.array([int((ws.counts > 0).sum())], pa.int64()), pa.array([int(ws.first[-1])], pa.int64()),
         bk.list_array(ids.take(pa.array(order)), np.array([len(ids)])), one(ws.counts[order], pa.int64()),
         one([n[:-1].decode("utf-8", "replace") for n in names], pa.string()), one(np.append(first, len(doc)), pa.int32()),
         one(doc, pa.int32()), one(tf, pa.int32())],
        names=["n_docs", "n_terms", "doc_ids", "sizes", "terms", "bounds", "docs", "tfs"])


def build_index(docs: DataFrame, terms: DataFrame | None = None, shard_bytes: int = SHARD, max_terms: int = MAX_TERMS) -> DataFrame:
    """The written index of ``docs(doc_id, text)``: of the words in ``terms(term)``
    if those are given and at most ``max_terms``, else of all words."""
    wanted = None
    if terms is not None:
        found = [r[0] for r in terms.select("term").distinct().limit(max_terms + 1).collect()]
        wanted = found if len(found) <= max_terms else None
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return written(src.mapInArrow(_shards(wanted, shard_bytes), _INDEX), "lexical-index")


def weights(index: DataFrame, terms: DataFrame) -> tuple[DataFrame, int, int]:
    """``terms`` with the weight of each term the index knows; N and L."""
    total = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    lists = index.select(F.explode(F.expr(
        "transform(terms, (t, i) -> struct(t AS term, cast(bounds[i + 1] - bounds[i] AS bigint) AS df))")).alias("x")).select("x.*")
    df = lists.groupBy("term").agg(F.sum("df").alias("df"))
    w = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * total["n"] + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("bigint")
    return terms.join(df, "term").withColumn("w", w), total["n"], total["l"]


def _packed(weighted: DataFrame) -> DataFrame:
    """Rows of about QUERIES queries each: their ids and, by query, terms and
    weights (the term's weight times its occurrences in the query)."""
    one = weighted.groupBy("item_id").agg(F.collect_list(F.struct("term", (F.col("w") * F.col("qtf")).alias("weight"))).alias("terms"))
    n = max(1, -(-weighted.select("item_id").distinct().count() // QUERIES))
    return (one.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n)).cast("int"))
            .groupBy("block").agg(F.collect_list(F.struct("item_id", "terms")).alias("queries")))


class Shard:
    """One shard of the index with the documents' parts of all its scores."""

    def __init__(self, doc_ids, sizes, terms, bounds, docs, tfs, n: int, total: int, block: int):
        self.doc_ids, self.count, self.block = doc_ids, len(sizes), block
        self.of = {t: i for i, t in enumerate(terms)}
        self.bounds, self.docs = bounds, docs
        m = 25 + (75 * sizes * n) // total
        tf = tfs.astype(np.int64)
        self.part = (1_000_000_000 * tf) // (1000 * tf + 8 * m[docs])
        self.blocks = -(-self.count // block)
        # runs of one term and one block of documents: where they start, and the largest part in each
        key = np.repeat(np.arange(len(terms)) * self.blocks, np.diff(bounds)) + docs // block
        self.run = np.flatnonzero(np.diff(key, prepend=-1))
        self.run_key = key[self.run]
        self.run_end = np.append(self.run[1:], len(key))
        self.run_max = np.maximum.reduceat(self.part, self.run) if len(key) else np.zeros(0, np.int64)

    def best(self, terms: list[tuple[str, int]], k: int, short: float = SHORT) -> tuple[list[tuple[int, int]], int, int]:
        """(score, position) of the best k documents with a score above 0, and
        how many blocks were walked and how many there are."""
        lists = [(self.of[t], w) for t, w in terms if w > 0 and t in self.of]
        size = lambda t: self.bounds[t + 1] - self.bounds[t]
        small = [(t, w) for t, w in lists if size(t) <= max(1, short * self.count)]
        long = [(t, w) for t, w in lists if size(t) > max(1, short * self.count)]
        sums = np.zeros(self.count, np.int64)              # the accumulators
        for t, w in small:
            a, b = self.bounds[t], self.bounds[t + 1]
            sums[self.docs[a:b]] += w * self.part[a:b]
        held = np.flatnonzero(sums)
        bound = np.zeros((len(long) + 1, self.blocks), np.int64)       # of the accumulators and of every long list, by block
        np.maximum.at(bound[0], held // self.block, sums[held])
        runs = []
        for i, (t, w) in enumerate(long):
            a, b = np.searchsorted(self.run_key, (t * self.blocks, (t + 1) * self.blocks))
            at = self.run_key[a:b] - t * self.blocks
            bound[i + 1, at] = w * self.run_max[a:b]
            runs.append(dict(zip(at.tolist(), zip(self.run[a:b].tolist(), self.run_end[a:b].tolist()))))
        least = int(np.partition(sums[held], -k)[-k]) if len(held) >= k else 1
        top: list[tuple[int, int]] = []
        total, walked = bound.sum(axis=0), 0
        for b in np.flatnonzero(total > 0).tolist():
            if total[b] < least:
                continue
            walked += 1
            base = b * self.block
            score = sums[base:base + self.block].copy()
            order = np.argsort(bound[:, b], kind="stable")
            ahead = np.concatenate([[0], np.cumsum(bound[order, b])])       # bounds of the lists before each one
            able = score > 0 if ahead[np.flatnonzero(order == 0)[0] + 1] >= least else np.zeros(len(score), bool)
            for rank in range(len(order) - 1, -1, -1):
                i, proposes = int(order[rank]) - 1, ahead[rank + 1] >= least
                if i < 0 or b not in runs[i]:
                    continue
                s, e = runs[i][b]
                docs, gain = self.docs[s:e] - base, long[i][1] * self.part[s:e]
                if proposes:
                    able[docs] = True
                else:                                       # no document of this and smaller lists alone can reach the least score
                    able &= score + ahead[rank + 1] >= least
                    if not able.any():
                        break
                    docs, gain = docs[able[docs]], gain[able[docs]]
                score[docs] += gain
            for d in np.flatnonzero(able & (score >= least)).tolist():
                top.append((int(score[d]), base + d))
            if len(top) >= k:
                top = sorted(top, key=lambda x: (-x[0], x[1]))[:k]
                least = max(least, top[-1][0])
        return sorted(top, key=lambda x: (-x[0], x[1]))[:k], walked, self.blocks


def _search(n: int, total: int, k: int, block: int, short: float):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                col = lambda c: batch.column(c)[row].values  # noqa: E731, B023
                ids = col("doc_ids")
                shard = Shard(ids, np.array(col("sizes")), col("terms").to_pylist(), np.array(col("bounds")), np.array(col("docs")),
                              np.array(col("tfs")), n, total, block)
                items, scores, places = [], [], []
                for q in batch.column("queries")[row].as_py():
                    for s, d in shard.best([(t["term"], t["weight"]) for t in q["terms"]], k, short)[0]:
                        items.append(q["item_id"])
                        scores.append(s)
                        places.append(d)
                if items:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(items, batch.schema.field("queries").type.value_type.field("item_id").type),
                         ids.take(pa.array(places, pa.int64())), pa.array(scores, pa.int64())], names=["item_id", "doc_id", "score"])
    return run


def search(index: DataFrame, terms: DataFrame, k: int = 10, block: int = BLOCK, short: float = SHORT,
           packed_bytes: int = PACKED_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: for each query of ``terms(item_id, term,
    qtf)`` the k best documents of the index with a score above 0."""
    weighted, n, total = weights(index, terms)
    packed = written(_packed(weighted), "lexical-queries")
    size = packed.agg(F.coalesce(F.sum(F.expr(
        "aggregate(queries, 0L, (s, q) -> s + 32 + aggregate(q.terms, 0L, (a, t) -> a + 16 + octet_length(t.term)))")), F.lit(0))).first()[0]
    blocks = packed.count()
    rows = index.select("doc_ids", "sizes", "terms", "bounds", "docs", "tfs").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1))))
    if size <= packed_bytes:
        pairs = rows.join(F.broadcast(packed), "block")
    else:                                                   # every block of queries once for each of some groups of shards
        groups = max(1, index.count() // 64)
        pairs = rows.withColumn("grp", F.pmod(F.xxhash64("doc_ids", "block"), F.lit(groups))).join(
            packed.withColumn("grp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint")))), ["block", "grp"]).drop("grp")
    kind = dict(terms.dtypes)["item_id"]
    found = pairs.drop("block").mapInArrow(_search(n, max(total, 1), k, block, short), f"item_id {kind}, doc_id bigint, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best of ``docs(doc_id, text)`` for each of ``items(item_id, text)``."""
    terms = written(query_terms(items), "lexical-terms")
    return search(build_index(docs, terms), terms, k)


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
sized AS (SELECT rid, doc_id, words, len(words) AS n FROM d WHERE len(words) > 0),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sized),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(words) AS term FROM sized) t GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
q AS (SELECT item_id, term, count(*) AS qtf FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark) b) t GROUP BY ALL),
scored AS (SELECT q.item_id, s.rid, s.doc_id, sum(q.qtf * CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df.df + 1))) AS BIGINT)
               * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * s.n * n_docs) // n_terms))))::BIGINT AS score
           FROM q JOIN df USING (term) JOIN tf USING (term) JOIN sized s USING (rid) CROSS JOIN total GROUP BY ALL),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
