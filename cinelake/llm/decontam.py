"""Benchmark decontamination by a prefix-filtered set join.

Items are cut into windows of ``WINDOW`` words (a shorter item is one window).
A window is a set of ``SHINGLE``-word shingles (a shorter window: itself). A
document contains a window only if it contains all its shingles, so one
necessary prefix token is enough: the shingle that is rarest in the corpus.
One pass over the documents finds the places of item shingles through a bitmap
of fixed size, with the words around them; their frequencies order the shingles
of each window by rarity; the places of prefix tokens are joined with the
windows, places too near to an end of the document for the window are
discarded, and the words of the rest are compared one by one.

Defined results: one row out per row in. Null, empty and wordless texts have no
words and are clean. Repeated rows get equal results. Items that are null or
without words have no window; an item without id marks words but is not listed.
Repeated items count once. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm import bytekernel as bk
from cinelake.llm.common import if_small, with_row_key, written

WINDOW = 13
SHINGLE = 5
MIN_ONE_IN = 20                # contaminated: at least one word in so many is hit
BITMAP_BITS = 1 << 24          # 2 MB, whatever the size of the benchmark
_BUCKET = 32768                # bits of a bucket of Spark's bitmap functions


def _words(ws: bk.Words, lo: int, hi: int) -> list[str]:
    return [bk.LOWER[ws.data[a:b]].tobytes().decode("utf-8", "replace")
            for a, b in zip(ws.starts[lo:hi].tolist(), ws.ends[lo:hi].tolist())]


def _shingles(ws: bk.Words, h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of whole shingles of ``width`` words, and their hashes."""
    at = bk.whole_windows(ws.first, width)
    return at, bk.window_hashes(h, width)[at].view(np.int64)


def _item_batches(window: int, shingle: int):
    def run(batches):
        for batch in batches:
            data, offsets = bk.text_buffers(batch.column("text"))
            ids = batch.column("item").to_pylist()
            rows = []
            for i in range(len(ids)):
                text = data[offsets[i]:offsets[i + 1]]
                ws = bk.find_words(text, np.array([0, len(text)]), bk.LETTER_DIGIT)
                n = len(ws.starts)
                if not n:
                    continue
                words, h = _words(ws, 0, n), bk.word_hashes(ws, bk.LOWER)
                size, width = min(window, n), min(shingle, n)
                _, hashes = _shingles(ws, h, width)
                for at in range(n - size + 1):
                    rows.append((ids[i], words[at:at + size], width, hashes[at:at + size - width + 1].tolist()))
                if len(rows) > 10_000:
                    yield _item_rows(rows)
                    rows = []
            if rows:
                yield _item_rows(rows)
    return run


def _item_rows(rows) -> pa.RecordBatch:
    a, b, c, d = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.string()), pa.array(b, pa.list_(pa.string())), pa.array(c, pa.int32()), pa.array(d, pa.list_(pa.int64()))],
        names=["item", "words", "width", "hashes"])


_REGION = pa.struct([("start", pa.int32()), ("words", pa.list_(pa.string())),
                     ("hits", pa.list_(pa.struct([("pos", pa.int32()), ("width", pa.int32()), ("hash", pa.int64())])))])
_REGION_SQL = "array<struct<start:int,words:array<string>,hits:array<struct<pos:int,width:int,hash:bigint>>>>"


def _regions(ws: bk.Words, hits: list[tuple[int, int, int]], doc: int, window: int) -> list[dict]:
    """Stretches of the document around its hits, a window to either side."""
    base, end = int(ws.first[doc]), int(ws.first[doc + 1])
    out, group = [], []
    for hit in hits + [None]:
        if group and (hit is None or hit[0] - group[-1][0] > 2 * window):
            lo, hi = max(base, group[0][0] - window), min(end, group[-1][0] + window)
            out.append({"start": lo - base, "words": _words(ws, lo, hi),
                        "hits": [{"pos": p - base, "width": w, "hash": h} for p, w, h in group]})
            group = []
        group.append(hit)
    return out


def _scan_batches(bitmap, widths: list[int], window: int):
    def run(batches):
        bits = np.frombuffer(bitmap.value, np.uint8)
        mask = np.int64(BITMAP_BITS - 1)
        for batch in batches:
            data, offsets = bk.text_buffers(batch.column("text"))
            for i, j in bk.doc_chunks(offsets):
                ws = bk.find_words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], bk.LETTER_DIGIT)
                h = bk.word_hashes(ws, bk.LOWER)
                found = []
                for width in widths:
                    at, hashes = _shingles(ws, h, width)
                    slot = hashes & mask
                    hit = np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                    found += zip(at[hit].tolist(), [width] * len(hit), hashes[hit].tolist())
                found.sort()
                by_doc: dict[int, list] = {}
                for f, doc in zip(found, (np.searchsorted(ws.first, [f[0] for f in found], "right") - 1).tolist()):
                    by_doc.setdefault(doc, []).append(f)
                regions = [_regions(ws, by_doc[d], d, window) if d in by_doc else [] for d in range(j - i)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, j - i) for c in ("doc_id", "k1", "k2")]
                    + [pa.array(ws.counts.astype(np.int64)), pa.array(regions, pa.list_(_REGION))],
                    names=["doc_id", "k1", "k2", "n_words", "regions"])
    return run


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item, words, width, hashes: distinct windows of the items."""
    src = items.select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    return src.mapInArrow(_item_batches(window, shingle), "item string, words array<string>, width int, hashes array<bigint>").distinct()


def _bitmap(windows: DataFrame) -> bytes:
    """Bits of the hashes of all item shingles; its size is fixed."""
    slots = windows.select(F.explode("hashes").alias("h")).select(F.col("h").bitwiseAND(F.lit(BITMAP_BITS - 1)).alias("s"))
    parts = slots.groupBy((F.col("s") / _BUCKET).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(F.pmod("s", F.lit(_BUCKET))).alias("bits")).collect()
    out = bytearray(BITMAP_BITS // 8)
    for r in parts:
        out[r["bucket"] * (_BUCKET // 8):(r["bucket"] + 1) * (_BUCKET // 8)] = r["bits"]
    return bytes(out)


def contained_windows(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(all documents with k1, k2 and n_words; verified places of item windows:
    k1, k2, start, size, item)."""
    spark = docs.sparkSession
    windows = written(item_windows(items, window, shingle), "decontam-windows")
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())     # at most SHINGLE values
    bitmap = spark.sparkContext.broadcast(_bitmap(windows))
    src = with_row_key(docs.select("doc_id", "text"), "doc_id", "text")
    scanned = written(src.mapInArrow(
        bk.releasing(_scan_batches(bitmap, widths, window)),
        f"doc_id {dict(src.dtypes)['doc_id']}, k1 bigint, k2 bigint, n_words bigint, regions {_REGION_SQL}"), "decontam-scan")
    regions = scanned.where(F.size("regions") > 0).select("k1", "k2", "n_words", F.explode("regions").alias("r"))
    places = regions.select("k1", "k2", "n_words", F.col("r.start").alias("r_start"), F.col("r.words").alias("r_words"),
                            F.explode("r.hits").alias("hit")).select("k1", "k2", "n_words", "r_start", "r_words", "hit.*")
    # rarity order: places of each shingle in the corpus; the rarest is the window's prefix
    frequency = places.groupBy("width", "hash").agg(F.count(F.lit(1)).alias("n_places"))
    distinct = windows.select("words", "width", "hashes").distinct()
    tokens = distinct.select("words", "width", F.posexplode("hashes").alias("offset", "hash"))
    ranked = tokens.join(frequency, ["width", "hash"], "left").groupBy("words", "width").agg(
        F.min(F.struct(F.coalesce("n_places", F.lit(0)).alias("n"), "hash", "offset")).alias("least"))
    prefix = if_small(ranked.where("least.n > 0").select("words", "width", "least.hash", "least.offset"), "decontam-prefix")
    size, start = F.size("words"), F.col("pos") - F.col("offset")
    near = (places.join(prefix, ["width", "hash"])
            .where((start >= 0) & (start + size <= F.col("n_words")))                     # positional and length bounds
            .where(F.slice("r_words", start - F.col("r_start") + 1, size) == F.col("words"))
            .select("k1", "k2", start.alias("start"), size.alias("size"), "words").distinct())
    found = near.join(if_small(windows.select("words", "item"), "decontam-items"), "words").select("k1", "k2", "start", "size", "item")
    return scanned.select("doc_id", "k1", "k2", "n_words"), written(found, "decontam-found")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, one_in: int = MIN_ONE_IN) -> DataFrame:
    """One row per document: n_words, n_hit (words inside windows), n_items,
    items_sha256, contaminated, and k1, k2."""
    all_docs, found = contained_windows(docs, items, window)
    words = (found.select("k1", "k2", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("w"))
             .distinct().groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_hit")))
    listed = (found.select("k1", "k2", "item").distinct().groupBy("k1", "k2").agg(
        F.count("item").alias("n_items"), F.concat_ws(",", F.sort_array(F.collect_list("item"))).alias("items")))
    per_doc = if_small(words.join(listed, ["k1", "k2"]), "decontam-docs")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return all_docs.join(per_doc, ["k1", "k2"], "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * one_in >= F.col("n_words"))).alias("contaminated"), "k1", "k2")


def drop_contaminated(docs: DataFrame, items: DataFrame, **limits) -> DataFrame:
    """Filter stage: the rows of ``docs`` that are not contaminated, unchanged."""
    bad = if_small(contamination(docs, items, **limits).where("contaminated").select("k1", "k2").distinct(), "decontam-bad")
    names = docs.columns
    keyed = with_row_key(docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in names])).select("_row", "doc_id", "text"),
                         "doc_id", "text")
    return keyed.join(bad, ["k1", "k2"], "left_anti").select(*[F.col("_row").getField(c).alias(c) for c in names])
