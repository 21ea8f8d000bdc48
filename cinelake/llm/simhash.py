"""SimHash near-duplicates with pivot distance tables.

A fingerprint has 64 bits; a bit is set if it is set in over half the XXH64
values of the text's word shingles. Equal fingerprints are collapsed first, so
copies never meet each other. For every distinct fingerprint the Hamming
distances to ``PIVOTS`` fixed reference fingerprints are computed once. Two
fingerprints d bits apart differ by at most d in every such coordinate; a pair
is discarded as soon as one coordinate differs by more, and the survivors are
verified bit by bit.

Which pairs are looked at is bounded without losing any: of ``BANDS`` bands of
bits, a pair within ``max_bits`` differs in at most ``max_bits`` bands, so it
agrees in some choice of ``BANDS - max_bits`` bands. Each choice is one join
key, together with a cell of one pivot coordinate: fingerprints that agree in
the bands but lie apart from the pivot never meet, however many share the
bands. A pair is emitted only for the first choice in which it agrees.

Defined results: one row out per row in. Null, empty and blank texts have
fingerprint zero and are linked with each other like any other. A null doc_id
takes part, but never names a component unless no other id is there (then the
component is null). Repeated rows are one group. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm import bytekernel as bk
from cinelake.llm.common import if_small, with_row_key, written
from cinelake.llm.graph import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
PIVOTS = 12
BANDS = 6                # 6 bands, 3 of them equal: 20 keys of 32 bits or so
CELL = 8                 # width of a pivot cell; a probe spans at most 2 of them


def pivot_values(n: int = PIVOTS) -> list[int]:
    """The reference fingerprints: XXH64 of their number, as signed longs."""
    return [int(np.uint64(xxhash.xxh64_intdigest(b"pivot %d" % i, SEED)).astype(np.int64)) for i in range(n)]


def chunk_fingerprints(data: np.ndarray, docs: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Fingerprints of the texts ``data[docs[i]:docs[i + 1]]``, as signed longs."""
    ws = bk.find_words(data, docs, bk.NOT_SPACE)
    if not len(ws.starts):
        return np.zeros(len(docs) - 1, np.int64)
    joined, starts, ends = bk.joined_words(ws, bk.LOWER)
    # a text of k words or more has a shingle at each word but the last k - 1; a shorter one is a shingle itself
    lone = np.flatnonzero((ws.counts > 0) & (ws.counts < k))
    at = np.sort(np.concatenate([bk.whole_windows(ws.first, k), ws.first[lone]]))
    last = np.minimum(at + k, np.repeat(ws.first[1:], ws.counts)[at]) - 1
    hashes = bk.xxh64_spans(joined, starts[at], ends[last], SEED)
    bounds = np.searchsorted(at, ws.first)
    counts = bk.bit_counts(hashes, bounds)
    bits = counts * 2 > np.diff(bounds)[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()


def _fingerprints(k: int):
    def run(batches):
        for batch in batches:
            data, offsets = bk.text_buffers(batch.column("text"))
            parts = [chunk_fingerprints(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
                     for i, j in bk.doc_chunks(offsets)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "k1", "k2")]
                + [pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), pa.int64())], names=["doc_id", "k1", "k2", "fp"])
    return run


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, k1, k2 (key of the row) and fp, the fingerprint as a signed long."""
    src = with_row_key(docs.select("doc_id", "text"), "doc_id", "text")
    return src.mapInArrow(bk.releasing(_fingerprints(k)), f"doc_id {dict(src.dtypes)['doc_id']}, k1 bigint, k2 bigint, fp bigint")


def _band_masks(bands: int) -> list[int]:
    edges = [64 * i // bands for i in range(bands + 1)]
    return [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _distance(a: Column, b) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("int")


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bands: int = BANDS, pivots: int = PIVOTS) -> DataFrame:
    """``a, b`` (a < b) for every pair of the distinct fingerprints ``fp`` that
    differ in 1 to ``max_bits`` bits."""
    masks = _band_masks(bands)
    choices = [_signed(reduce(int.__or__, (masks[i] for i in c))) for c in combinations(range(bands), bands - max_bits)]
    refs = pivot_values(pivots)
    table = distinct.select("fp", *[_distance(F.col("fp"), F.lit(p)).cast("tinyint").alias(f"p{i}") for i, p in enumerate(refs)])
    keyed = table.withColumn("c", F.explode(F.array(*[F.struct(
        F.lit(i).cast("tinyint").alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("band"),
        F.col(f"p{i % pivots}").cast("int").alias("d")) for i, m in enumerate(choices)])))
    keyed = keyed.select("fp", *[f"p{i}" for i in range(pivots)], "c.*")
    held = keyed.withColumn("cell", F.floor(F.col("d") / CELL)).drop("d")
    probe = keyed.withColumn("cell", F.explode(F.sequence(F.floor((F.col("d") - max_bits) / CELL), F.floor((F.col("d") + max_bits) / CELL)))).drop("d")
    a, b = held.alias("a"), probe.alias("b")
    near = [F.abs(F.col(f"a.p{i}").cast("int") - F.col(f"b.p{i}").cast("int")) <= max_bits for i in range(pivots)]
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    first = reduce(lambda rest, im: F.when(differ.bitwiseAND(F.lit(im[1])) == 0, F.lit(im[0])).otherwise(rest),
                   reversed(list(enumerate(choices))), F.lit(-1))
    cond = ((F.col("a.choice") == F.col("b.choice")) & (F.col("a.band") == F.col("b.band")) & (F.col("a.cell") == F.col("b.cell"))
            & (F.col("a.fp") < F.col("b.fp")) & reduce(Column.__and__, near)
            & (F.bit_count(differ) <= max_bits) & (F.col("a.choice").cast("int") == first))
    # never broadcast: Spark sizes a side as the fingerprints before they are exploded into 20 keys and more
    return a.hint("merge").join(b.hint("merge"), cond).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id
    (smallest doc_id reachable over links), fp, and k1, k2."""
    prints = written(fingerprints(docs, k), "simhash-prints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-classes")
    joined = written(components(links(classes.select("fp"), max_bits)), "simhash-components")
    member = (classes.join(joined, classes.fp == joined.node, "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    smallest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    # only fingerprints of more than one document, or with links, name another id than their own
    moved = member.join(smallest, "root").select("fp", "component_id", F.col("root").alias("class"))
    named = if_small(moved, "simhash-named")
    return (prints.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp", "class", "k1", "k2"))


def keep_one(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Filter stage: of each component the row with the smallest doc_id (then
    the smallest key) stays, unchanged; of repeated rows one stays."""
    found = near_duplicates(docs, k, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k1", "k2")
    chosen = found.groupBy("class").agg(F.min(order).alias("m"))
    rows = found.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_rows"))
    chosen = written(chosen.select("m.k1", "m.k2").join(rows, ["k1", "k2"]), "simhash-kept")
    names = docs.columns
    keyed = with_row_key(docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in names])).select("_row", "doc_id", "text"),
                         "doc_id", "text")
    out = keyed.join(chosen, ["k1", "k2"])
    once = out.where("n_rows = 1").select("_row")
    many = out.where("n_rows > 1").dropDuplicates(["k1", "k2"]).select("_row")
    return once.unionByName(many).select(*[F.col("_row").getField(c).alias(c) for c in names])
