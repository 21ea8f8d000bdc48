"""Lexical retrieval packing of token sequences.

Every document is a list of token ids with an end id. Whole windows at its
start are sequences by themselves; what is left (its tail, shorter than a
window) is packed with the tails of related documents. Tails are brought near
related ones by sorting on min-hashes of their ids, and consecutive tails form
shards of bounded size. In each shard a BM25 inverted index over the tails'
ids is built; the longest unused tail is the seed of a window, the index
returns its unused neighbours in order of their scores, and they fill the
window greedily, the last one cut to fit; the rest of that one stays in the
shard. So every window of a shard is full; what cannot fill one goes on to the
next shard of the task, and the very last ids of a task are cut into sequences
whose lengths are powers of two, which need no padding.

Defined results: each id of each row lies in exactly one piece. A null or empty
text is its end id alone. Repeated rows are packed like others, each with its
own pieces. An empty table has no pieces. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm import bytekernel as bk
from cinelake.llm.common import mixed_partitions, written
from cinelake.llm.tokens import encoder, row_groups, with_end

WINDOW = 2048
SHARD = 512                    # tails of one inverted index
K1, B = 1.2, 0.75              # BM25
SKETCH = 3                     # min-hashes that order the tails

_FIELDS = [("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())]


def _sketches(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One long per range of ``bounds``: SKETCH min-hash ids of 21 bits each."""
    out = np.zeros(len(bounds) - 1, np.int64)
    for seed in range(SKETCH):
        h = (ids.astype(np.uint64) + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15 + 2 * seed)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        least = np.minimum.reduceat(h >> np.uint64(20), bounds[:-1])
        out = (out << 21) | (least & np.uint64((1 << 21) - 1)).astype(np.int64)
    return out


def _tokenise(path: str, window: int, end_id: int, special: bool):
    def run(batches):
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for i, j, flat, bounds in encoder(path, special).encode(batch.column("text")):
                flat, bounds = with_end(flat, bounds, end_id)
                total = np.diff(bounds)
                count = -(-total // window)
                row = np.repeat(np.arange(j - i), count)
                start = window * (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
                size = np.minimum(window, total[row] - start)
                cuts = np.concatenate([[0], np.cumsum(size)])
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(4 * cuts), pa.py_buffer(flat.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(i, j - i).take(pa.array(row)), pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                     raw.cast(pa.binary()), pa.array(total[row], pa.int64()), pa.array(_sketches(flat, cuts), pa.int64())],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sketch"])
    return run


class Shard:
    """BM25 inverted index over the ids of some tails."""

    def __init__(self, tails: list[np.ndarray]):
        n = self.n = len(tails)
        size = np.array([len(t) for t in tails])
        doc = np.repeat(np.arange(n), size)
        key, tf = np.unique(np.concatenate(tails).astype(np.int64) * n + doc, return_counts=True)
        term, self.doc = key // n, key % n
        self.terms, self.first = np.unique(term, return_index=True)
        self.first = np.append(self.first, len(term))
        df = np.diff(self.first)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * size / size.mean())
        self.weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm[self.doc])
        order = np.argsort(self.doc, kind="stable")        # term positions of each tail
        self.own = np.split(np.repeat(np.arange(len(df)), df)[order], np.cumsum(np.bincount(self.doc, minlength=n))[:-1])

    def scores(self, seed: int) -> np.ndarray:
        a = self.first[self.own[seed]]
        size = self.first[self.own[seed] + 1] - a
        ends = np.cumsum(size)
        at = np.repeat(a - (ends - size), size) + np.arange(int(ends[-1]))
        return np.bincount(self.doc[at], self.weight[at], self.n)


def fill_windows(tails: list[np.ndarray], window: int = WINDOW):
    """Windows as lists of (tail, from, to); and what stays: (tail, from)."""
    index = Shard(tails)
    at = np.zeros(len(tails), np.int64)
    size = np.array([len(t) for t in tails])
    total = int(size.sum())
    used = np.zeros(len(tails), bool)
    windows = []
    seeds = iter(np.argsort(-size, kind="stable").tolist())
    while total >= window:
        seed = next(s for s in seeds if not used[s])
        scores = index.scores(seed)
        scores[used] = -1.0
        scores[seed] = np.inf
        space, pieces = window, []
        for d in np.argsort(-scores, kind="stable").tolist():
            take = min(space, int(size[d] - at[d]))
            pieces.append((d, int(at[d]), int(at[d]) + take))
            at[d] += take
            used[d] = at[d] == size[d]
            space -= take
            if not space:
                break
        windows.append(pieces)
        total -= window
    return windows, [(d, int(at[d])) for d in range(len(tails)) if not used[d]]


def _pack(window: int, shard: int):
    def run(batches):
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        sequence = task << 40
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

        def emit(tails, windows):
            nonlocal sequence
            rows = []
            for pieces in windows:
                offset = 0
                for d, a, b in pieces:
                    row, ids = tails[d]
                    rows.append((row[0], row[1] + a, b - a, ids[a:b].tobytes(), row[2], sequence, offset))
                    offset += b - a
                sequence += 1
            cols = list(zip(*rows))
            kinds = [doc_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        pool, fresh, doc_type = [], 0, None   # pool: ((doc_id, start, doc_tokens), ids)
        for batch in row_groups(batches):
            doc_type = batch.column("doc_id").type
            for r in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))):
                pool.append((r[:3], np.frombuffer(r[3], "<u4")))
                fresh += 1
                if fresh == shard:
                    windows, left = fill_windows([ids for _, ids in pool], window)
                    if windows:
                        yield emit(pool, windows)
                    pool = [((row[0], row[1] + a, row[2]), ids[a:]) for d, a in left for row, ids in [pool[d]]]
                    fresh = 0
        if pool:
            windows, left = fill_windows([ids for _, ids in pool], window)
            windows += _powers_of_two([(d, a, len(pool[d][1])) for d, a in left])
            yield emit(pool, windows)
    return run


def _powers_of_two(pieces):
    """The pieces cut into sequences whose lengths are falling powers of two."""
    total = sum(b - a for _, a, b in pieces)
    out, space, at = [], 0, 0
    for d, a, b in pieces:
        while a < b:
            if not space:
                space = 1 << ((total - at).bit_length() - 1)
                out.append([])
            take = min(space, b - a)
            out[-1].append((d, a, a + take))
            a, at, space = a + take, at + take, space - take
    return out


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 1, shard: int = SHARD,
         special: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset."""
    src = docs.select("doc_id", "text")
    kind = dict(src.dtypes)["doc_id"]
    parts = written(src.mapInArrow(
        bk.releasing(_tokenise(tokenizer, window, end_id, special)),
        f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sketch bigint"), "packing-parts")
    out = f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    full = (parts.where(F.col("length") == window)
            .select("doc_id", "start", "length", "ids", "doc_tokens", (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
                    F.lit(0).cast("bigint").alias("offset")))
    tails = (parts.where(F.col("length") < window)
             .repartitionByRange(mixed_partitions(docs.sparkSession), "sketch", "doc_id", "start")
             .sortWithinPartitions("sketch", "doc_id", "start")
             .select("doc_id", "start", "doc_tokens", "ids"))
    return full.unionByName(tails.mapInArrow(bk.releasing(_pack(window, shard)), out))
