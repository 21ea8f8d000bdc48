"""Token-id files: whole texts as range-coded ids in ascending order of doc_id.

A token file is a folder with a table of segments. A segment holds the ids of
whole documents one after the other, each with an end id, as one coded binary
value of the range coder (independently reset, checksummed blocks), with the
documents' ids and sizes beside it. ``part`` and ``number`` order the segments,
``before`` counts the ids of the part's earlier segments; a part covers a range
of doc_ids, and parts follow one another in that order.

Defined results: one document per row in. A null or empty text is its end id
alone. Rows with equal doc_ids stand next to each other, in the order of their
texts; null doc_ids come first. An empty table gives a file without segments.
Other columns are ignored, whatever their names. A damaged block, or one that
is missing, fails the reading job.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.llm import bytekernel as bk
from cinelake.llm.common import mixed_partitions
from cinelake.llm.rangecoder import BLOCK, pack_segment, unpack_segment
from cinelake.llm.tokens import encoder, with_end

SEGMENT = 4096 * BLOCK         # ids from which a segment is closed
CACHED = 1_200_000             # units of text that a worker remembers


def _write(path: str, end_id: int, segment: int, special: bool):
    def run(batches):
        part = TaskContext.get().partitionId()
        number = before = held = 0
        names, sizes, ids = [], [], []

        def close():
            nonlocal number, before, held, names, sizes, ids
            flat, docs = np.concatenate(ids), pa.concat_arrays(names)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([len(flat)], pa.int64()),
                 bk.list_array(docs, np.array([len(docs)])), bk.list_array(np.concatenate(sizes), np.array([len(docs)])),
                 pa.array([pack_segment(flat)], pa.binary())],
                names=["part", "number", "before", "n_ids", "doc_ids", "doc_tokens", "data"])
            number, before, held, names, sizes, ids = number + 1, before + len(flat), 0, [], [], []
            return row

        for batch in batches:
            doc_ids = batch.column("doc_id")
            for i, j, flat, bounds in encoder(path, special, CACHED).encode(batch.column("text")):
                flat, bounds = with_end(flat, bounds, end_id)
                a, n = 0, j - i
                while a < n:           # whole documents up to the one that fills the segment
                    b = min(int(np.searchsorted(bounds, bounds[a] + segment - held)), n)
                    names.append(doc_ids.slice(i + a, b - a))
                    sizes.append(np.diff(bounds[a:b + 1]))
                    ids.append(flat[bounds[a]:bounds[b]])
                    held += int(bounds[b] - bounds[a])
                    a = b
                    if held >= segment:
                        yield close()
        if held:
            yield close()
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, segment: int = SEGMENT, special: bool = False) -> None:
    """Encodes ``docs(doc_id, text)`` and writes the token file ``path``. With
    ``special``, strings of special tokens in a text are ordinary text."""
    src = docs.select("doc_id", "text")
    ordered = (src.repartitionByRange(mixed_partitions(docs.sparkSession), F.col("doc_id"), F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    kind = dict(src.dtypes)["doc_id"]
    ordered.mapInArrow(bk.releasing(_write(tokenizer, end_id, segment, special)),
                       f"part int, number int, before bigint, n_ids bigint, doc_ids array<{kind}>, doc_tokens array<bigint>, data binary"
                       ).write.parquet(path)


def _read(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            names = batch.column("doc_ids")[i].values
            sizes = np.array(batch.column("doc_tokens")[i].values)
            ids = unpack_segment(batch.column("data")[i].as_py())
            ends = np.cumsum(sizes)
            if int(sizes.sum()) != len(ids) or len(ids) != batch.column("n_ids")[i].as_py():
                raise ValueError("a segment does not hold the ids of its documents")
            raw = ids.astype("<u4").tobytes()
            start = batch.column("first")[i].as_py() + ends - sizes
            for a in range(0, len(sizes), 1000):
                b = min(a + 1000, len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [names.slice(a, b - a), pa.array(start[a:b], pa.int64()), pa.array(sizes[a:b], pa.int64()),
                     pa.array([raw[4 * (e - s):4 * e] for s, e in zip(sizes[a:b].tolist(), ends[a:b].tolist())], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens
    (with the end id), ids (little-endian unsigned 32-bit)."""
    segments = spark.read.parquet(path)
    # one row for each part, of which there are as many as tasks wrote
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"), F.count(F.lit(1)).alias("k"), F.max("number").alias("last")).collect()
    if any(r["k"] != r["last"] + 1 for r in totals):
        raise ValueError("a segment is missing or doubled")
    at, firsts = 0, []
    for r in sorted(totals, key=lambda r: r["part"]):
        firsts.append((r["part"], at))
        at += r["n"]
    offsets = spark.createDataFrame(firsts, "of_part int, part_start bigint")
    kind = dict(segments.dtypes)["doc_ids"][6:-1]
    rows = segments.join(F.broadcast(offsets), F.col("part") == F.col("of_part")).select(
        (F.col("part_start") + F.col("before")).alias("first"), "n_ids", "doc_ids", "doc_tokens", "data")
    return rows.mapInArrow(bk.releasing(_read), f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")
