"""Improbable-feature digests of texts.

The features of a text are its ``WIDTH``-byte windows, one from every byte on.
A window's entropy falls into a class; classes are ranked by how seldom they are
among the windows of all texts (``rarity``), those of little entropy last. Of
every ``NEAR`` windows in a row the rarest, or the leftmost of equally rare ones,
gets a vote; windows with ``VOTES`` votes are selected, and the rarest of each
text. Selected windows are hashed (XXH64) and inserted, each distinct one once,
into a chain of Bloom filters of ``BITS`` bits, the next filter beginning after
``ITEMS`` windows. Likeness of two digests: for each filter of the one with
fewer, the best normalised bit overlap with any filter of the other (shared bits
beyond what chance gives, over the most there could be), averaged.

Neighbours in falling doc_id meet without a global sort in one task: ids are cut
into ranges, every range gets one look-ahead row of the range behind it (the
last one that of the first), and texts flow through a range in order.

Defined results: one row out per row in. A null text is empty; an empty text has
a fingerprint without filters. A text shorter than a window is one feature.
Equal fingerprints have likeness 1, an empty and another one 0. Rows stand in
falling doc_id, equal doc_ids in order of their texts, null doc_ids last. A
single row is its own neighbour. An empty table gives no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm import bytekernel as bk
from cinelake.llm.common import mixed_partitions

WIDTH = 32
NEAR = 32                      # a power of two
VOTES = 8
BITS = 2048
ITEMS = 160                    # windows of one filter
HASHES = 5                     # of 11 bits each
SPARSE = 16                    # a last filter of fewer windows is not compared
LOW_ENTROPY = 0.2              # of the most a window can have; less is ranked last
CHANCE = 0.1                   # share of the possible overlap beyond chance that counts as none
GROUP = 1 << 21                # bytes of texts that are digested together, or one longer text
RANGES = 4000                  # of ids, at most

_SHIFT = 17
# n * log2(n) in fixed point for the counts of a byte in a window, and its steps
_SUMS = np.array([round((1 << 20) * n * np.log2(n)) if n else 0 for n in range(WIDTH + 1)], np.int32)
_STEPS = np.append(np.diff(_SUMS), 0).astype(np.int32)
CLASSES = (int(_SUMS[WIDTH]) >> _SHIFT) + 1
_PIECE = 1 << 16


def window_classes(data: np.ndarray) -> np.ndarray:
    """Entropy class of the window from every byte on (0: all bytes alike)."""
    n = len(data) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, np.uint16)
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)    # equal bytes among the WIDTH - 1 before / behind
    same = np.empty(_PIECE + WIDTH, np.uint8)
    for a in range(0, len(data), _PIECE):                    # pieces that stay in the processor's cache
        b = min(a + _PIECE, len(data))
        for d in range(1, WIDTH):
            lo = max(a, d)
            if lo < b:
                hit = np.equal(data[lo:b], data[lo - d:b - d], out=same[:b - lo].view(bool)).view(np.uint8)
                before[lo:b] += hit
                after[lo - d:b - d] += hit
    total = np.empty(n, np.int32)
    total[0] = _SUMS[np.bincount(data[:WIDTH], minlength=256)].sum()
    total[1:] = _STEPS[before[WIDTH:]] - _STEPS[after[:n - 1]]
    np.cumsum(total, out=total)
    return ((_SUMS[WIDTH] - total) >> _SHIFT).astype(np.uint16)


def _feature_counts(sizes: np.ndarray) -> np.ndarray:
    """How many features texts of these sizes have."""
    return np.where(sizes >= WIDTH, sizes - WIDTH + 1, np.minimum(sizes, 1))


def _class_counts(batches):
    counts = np.zeros(CLASSES, np.int64)
    for batch in batches:
        data, offsets = bk.text_buffers(batch.column("text"))
        for i, j in bk.doc_chunks(offsets, GROUP):
            docs = offsets[i:j + 1] - offsets[i]
            classes = window_classes(data[offsets[i]:offsets[j]])
            size = np.diff(docs)
            edge = np.zeros(len(classes) + 1, np.int8)       # windows inside one text
            whole = size >= WIDTH
            edge[docs[:-1][whole]] += 1
            edge[np.minimum(docs[1:][whole] - WIDTH + 1, len(classes))] -= 1
            counts += np.bincount(classes[np.cumsum(edge[:-1], dtype=np.int8) > 0], minlength=CLASSES)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64())], names=["class", "n"])


def rarity(docs: DataFrame) -> np.ndarray:
    """Rank of every entropy class, the rarest among all windows first."""
    found = docs.select("text").mapInArrow(_class_counts, "class int, n bigint").groupBy("class").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(CLASSES, np.int64)                     # one row a class at most
    for r in found:
        counts[r["class"]] = r["n"]
    low = np.arange(CLASSES) < LOW_ENTROPY * CLASSES
    rank = np.empty(CLASSES, np.int64)
    rank[np.lexsort((np.arange(CLASSES), counts, low))] = np.arange(CLASSES)
    return rank


def _selected(data: np.ndarray, docs: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Where the selected windows of the texts start, in order."""
    size = np.diff(docs)
    features = _feature_counts(size)
    full = np.flatnonzero(size)
    if not len(full):
        return np.zeros(0, np.int64)
    classes = window_classes(data)
    key = np.zeros(len(data), np.int64)
    key[:len(classes)] = rank[classes]
    key = (key << 40) | np.arange(len(key))
    least = key.copy()
    width = 1
    while width < NEAR:
        least[:-width] = np.minimum(least[:-width], least[width:])
        width *= 2
    edge = np.zeros(len(data) + 1, np.int8)                  # runs of NEAR windows inside one text
    near = features >= NEAR
    edge[docs[:-1][near]] += 1
    edge[docs[:-1][near] + features[near] - NEAR + 1] -= 1
    runs = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8) > 0)
    place = (1 << 40) - 1
    votes = np.bincount(least[runs] & place, minlength=len(data))
    cuts = np.empty(2 * len(full), np.int64)
    cuts[0::2], cuts[1::2] = docs[:-1][full], docs[:-1][full] + features[full]
    rarest = np.minimum.reduceat(np.append(key, 0), cuts)[0::2] & place
    chosen = votes >= VOTES
    chosen[rarest] = True
    return np.flatnonzero(chosen)


def digests(data: np.ndarray, docs: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The filters of all texts one after the other (rows of BITS / 64 longs),
    where each text's filters begin, and how many windows each text inserted."""
    n = len(docs) - 1
    starts = _selected(data, docs, rank)
    doc = np.searchsorted(docs, starts, "right") - 1
    hashes = bk.xxh64_spans(data, starts, np.minimum(starts + WIDTH, docs[doc + 1]), 0)
    order = np.lexsort((hashes, doc))                        # stable: the first of equal windows of a text stays
    same = np.zeros(len(order), bool)
    same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    keep = np.sort(order[~same])
    hashes, doc = hashes[keep], doc[keep]
    items = np.bincount(doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(-(-items // ITEMS))])
    number = np.arange(len(doc)) - np.repeat(np.cumsum(items) - items, items)
    bits = np.zeros((int(first[-1]), BITS), bool)
    for k in range(HASHES):
        bits[first[doc] + number // ITEMS, (hashes >> np.uint64(11 * k)).astype(np.int64) & (BITS - 1)] = True
    return np.packbits(bits, axis=1, bitorder="little").view("<u8"), first, items


def as_text(filters: np.ndarray, items: int) -> str:
    """A fingerprint: the number of windows and the filters in base 64."""
    return f"{items}:{base64.b64encode(filters.tobytes()).decode()}"


def from_text(fingerprint: str) -> tuple[np.ndarray, int]:
    items, _, filters = fingerprint.partition(":")
    return np.frombuffer(base64.b64decode(filters), "<u8").reshape(-1, BITS // 64), int(items)


def likeness(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int) -> float:
    """Of two digests given by their filters and numbers of windows, 0 to 1."""
    if n_a == n_b and np.array_equal(a, b):
        return 1.0
    if not n_a or not n_b:
        return 0.0
    if (len(b), n_b) < (len(a), n_a):
        a, n_a, b, n_b = b, n_b, a, n_a
    if len(a) > 1 and n_a - ITEMS * (len(a) - 1) < SPARSE:
        a = a[:-1]
    if len(b) > 1 and n_b - ITEMS * (len(b) - 1) < SPARSE:
        b = b[:-1]
    of_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    best = []
    step = max(1, (1 << 16) // len(b))
    for i in range(0, len(a), step):
        part = a[i:i + step]
        shared = np.bitwise_count(part[:, None, :] & b[None, :, :]).sum(axis=2, dtype=np.int64)
        of_a = np.bitwise_count(part).sum(axis=1, dtype=np.int64)[:, None]
        most, chance = np.minimum(of_a, of_b), of_a * of_b / BITS
        found = (shared - chance) / np.maximum(most - chance, 1e-9)
        best.append(np.where(found > CHANCE, np.clip(found, 0.0, 1.0), 0.0).max(axis=1))
    return float(np.concatenate(best).mean())


def fingerprints(texts: list[str], rank: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Filters and number of windows of each text."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    docs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    filters, first, items = digests(np.frombuffer(b"".join(raw), np.uint8), docs, rank)
    return [(filters[a:b], n) for a, b, n in zip(first[:-1].tolist(), first[1:].tolist(), items.tolist())]


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _edited(text: str, other: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def _compare(rank: np.ndarray, kind):
    def group(rows, beyond: str):
        """Rows (doc_id, text) in order, and the text behind the last one."""
        texts = [t for _, t in rows]
        edited = [_edited(t, o) for t, o in zip(texts, [*texts[1:], beyond])]
        own, new = fingerprints([*texts, beyond], rank), fingerprints(edited, rank)
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in rows], kind), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([hashlib.sha256(e.encode("utf-8", "replace")).hexdigest() for e in edited]),
             pa.array([as_text(*f) for f in own[:-1]]), pa.array([as_text(*f) for f in new]),
             pa.array([likeness(*f, *e) for f, e in zip(own, new)]), pa.array([likeness(*f, *o) for f, o in zip(own, own[1:])])],
            names=_NAMES)

    def run(batches):
        held, size, bucket, closed = [], 0, None, False      # rows whose neighbour is still to come
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                for b, ahead, d, t in zip(*(part.column(c).to_pylist() for c in ("bucket", "ahead", "doc_id", "text"))):
                    t = t or ""
                    if b != bucket:
                        assert not held, "a range without a look-ahead row"
                        bucket, closed = b, False
                    if ahead and not closed and held:
                        yield group(held, t)
                        held, size, closed = [], 0, True
                    elif not ahead:
                        if held and size + len(t) > GROUP:
                            yield group(held, t)
                            held, size = [], 0
                        held.append((d, t))
                        size += len(t)
        assert not held, "a range without a look-ahead row"
    return run


def _ranged(bounds: np.ndarray, heads: dict[int, int | None] | None):
    """Rows with the number of their range of ids, falling; with ``heads``, the
    first row of a range is sent to the range before it as well."""
    n = len(bounds)
    used = sorted(heads) if heads else []
    before = {b: used[i - 1] for i, b in enumerate(used)}

    def buckets(ids: pa.Array) -> np.ndarray:
        known = np.asarray(ids.fill_null(0).to_numpy(zero_copy_only=False))
        out = n - np.searchsorted(bounds, known, "left")     # ids above the largest bound come first
        out[ids.is_null().to_numpy(zero_copy_only=False)] = n + 1
        return out

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            own = buckets(ids)
            if heads is None:
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), ids], names=["bucket", "doc_id"])
                continue
            firsts: dict[int, tuple] = {}                    # of each range: of the rows with its first id, the first text
            plain = ids.to_pylist()
            for i in np.flatnonzero([heads[b] == d for b, d in zip(own.tolist(), plain)]).tolist():
                text = batch.column("text")[i].as_py()
                key = (text is not None, text or "")
                if int(own[i]) not in firsts or key < firsts[int(own[i])][0]:
                    firsts[int(own[i])] = (key, i)
            rows = np.concatenate([np.arange(batch.num_rows), [i for _, i in firsts.values()]]).astype(np.int64)
            to = np.concatenate([own, [before[b] for b in firsts]]).astype(np.int32)
            ahead = np.arange(len(rows)) >= batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(ahead), ids.take(pa.array(rows)), batch.column("text").take(pa.array(rows))],
                                             names=["bucket", "ahead", "doc_id", "text"])
    return run


def compare_neighbours(docs: DataFrame, rank: np.ndarray | None = None) -> DataFrame:
    """For every row of ``docs(doc_id, text)``: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, where the edited
    text has the second half replaced by the beginning of the next document.
    ``rank`` is a table of ``rarity``, by default that of ``docs``."""
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rank = rarity(src) if rank is None else rank
    n = min(RANGES, mixed_partitions(docs.sparkSession))
    shares = [i / n for i in range(1, n)] or [0.5]
    cuts = src.select("doc_id").where(F.col("doc_id").isNotNull()).approxQuantile("doc_id", shares, 0.1 / n)
    bounds = np.unique(np.array(cuts, np.float64))
    heads = {r["bucket"]: r["head"] for r in src.select("doc_id").mapInArrow(_ranged(bounds, None), "bucket int, doc_id bigint")
             .groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()}          # one row a range
    rows = src.mapInArrow(_ranged(bounds, heads), "bucket int, ahead boolean, doc_id bigint, text string")
    ordered = rows.repartitionById(len(bounds) + 2, F.col("bucket")).sortWithinPartitions(
        "bucket", "ahead", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))
    return ordered.mapInArrow(_compare(rank, pa.int64()), "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                              "edited_fingerprint string, near_edited double, near_next double")
