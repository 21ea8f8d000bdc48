"""Hard-negative mining by angular triangle filtering.

Every row keeps its integer vector, its norm and its angles to some reference
directions. For an anchor and a row the triangle inequality of angles gives, by
each reference, the least and the largest angle they can enclose; times the
norms, and widened by more than any rounding, that bounds their score. A pair's
score is computed only if its bounds overlap a window of wanted scores:

* positives: the wanted scores of a block are those from the k-th largest lower
  bound on;
* negatives: the windows ``low * p <= 100 * score <= high * p`` of the anchor's
  positives ``p``, and of a block only as far down as its own first ``n``.

Rows lie in hashed blocks of bounded size, whatever their labels; each anchor
block meets each row block as one group, which returns the best few of every
anchor. Scores are exact integers: sums stay below 2**53 in double precision or
are taken in 64-bit integers.

Reference directions: ``REFERENCES`` rows of a sample of at most ``SAMPLE`` rows
(by hash), each the farthest in angle from those before. They steer how much is
filtered, never the result.

Defined results: rows with a null vec_id, label or vector, or a null or
non-finite component take no part, nor do rows whose squared integer norm is
2**59 or more (their scores do not fit 64 bits). Of several rows with one
vec_id, the one with the least (label, vector) counts. Shorter vectors are
filled up with zeros; an empty one scores zero with every row. Equal scores are
ordered by vec_id. No anchors, no positives or an empty table give no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm import bytekernel as bk
from cinelake.llm.common import mixed_partitions, written

SCALE = 256
REFERENCES = 16
SAMPLE = 2000
ROWS = 4096                    # of a row block, on average
ANCHORS = 512                  # of an anchor block, on average
MAX_COMPONENT = float(1 << 22)
MAX_NORM2 = float(1 << 59)
SLACK = 1e-6                   # radians by which bounds of angles are widened

_BLOCK = "blk int, vec_id array<bigint>, label array<bigint>, vec binary, angle binary, norm binary, positives array<array<bigint>>"


def vectors(rows: DataFrame, shift_every: int = 7, n_labels: int = 10) -> DataFrame:
    """vec_id, label, q (integer components): the rows that take part."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) <= MAX_COMPONENT))
    q = F.when(fine, F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("int")))
    label = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % shift_every == 0, (label + 1) % n_labels).otherwise(label)
    out = (rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull())
           .select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), q.alias("q")).where(F.col("q").isNotNull())
           .where(F.aggregate("q", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")) < MAX_NORM2))
    return out.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q")


def _matrix(column, dim: int) -> np.ndarray:
    """The int lists of an Arrow column as a matrix, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(column), dim))
    size = np.diff(np.asarray(column.offsets))
    out[np.repeat(np.arange(len(column)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = column.flatten()
    return out


def angles(vec: np.ndarray, norm: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of every vector to every direction (a zero vector's do not count)."""
    return np.arccos(np.clip(vec @ directions.T / np.maximum(norm, 1e-300)[:, None], -1.0, 1.0))


def reference_directions(vecs: DataFrame, dim: int, count: int = REFERENCES, sample: int = SAMPLE) -> np.ndarray:
    """Unit rows of the sample, each the farthest from those chosen before."""
    rows = vecs.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("q").toArrow()
    pool = _matrix(rows.column("q"), dim) if rows.num_rows else np.zeros((0, dim))
    size = np.linalg.norm(pool, axis=1)
    pool = pool[size > 0] / size[size > 0, None]
    chosen = list(pool[:1])
    near = np.full(len(pool), -1.0)
    while chosen and len(chosen) < min(count, len(pool)):
        near = np.maximum(near, pool @ chosen[-1])
        chosen.append(pool[int(np.argmin(near))])
    return np.array(chosen) if chosen else np.zeros((0, dim))


def _pack(directions: np.ndarray, dim: int, with_windows: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        vec = _matrix(table.column("q"), dim)
        norm = np.linalg.norm(vec, axis=1)
        one = lambda x, kind: bk.list_array(pa.array(x, kind), np.array([table.num_rows]))
        scores = table.column("positives").to_pylist() if with_windows else [[]] * table.num_rows
        return pa.table(
            [pa.array(table.column("blk").to_numpy()[:1], pa.int32()), one(table.column("vec_id").to_numpy(), pa.int64()),
             one(table.column("label").to_numpy(), pa.int64()), pa.array([vec.astype("<i4").tobytes()], pa.binary()),
             pa.array([angles(vec, norm, directions).astype("<f8").tobytes()], pa.binary()), pa.array([norm.astype("<f8").tobytes()], pa.binary()),
             one(scores, pa.list_(pa.int64()))],
            names=["blk", "vec_id", "label", "vec", "angle", "norm", "positives"])
    return run


def _blocks(vecs: DataFrame, n: int, directions: np.ndarray, dim: int, with_windows: bool = False) -> DataFrame:
    kept = vecs.select("vec_id", "label", "q", *(["positives"] if with_windows else []))
    return (kept.withColumn("blk", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
            .groupBy("blk").applyInArrow(_pack(directions, dim, with_windows), _BLOCK))


class Block:
    """The rows of one block, in ascending vec_id."""

    def __init__(self, table: pa.Table, dim: int):
        get = lambda c: table.column(c)[0]
        self.ids, self.label = np.array(get("vec_id").values), np.array(get("label").values)
        n = len(self.ids)
        self.vec = np.frombuffer(get("vec").as_py(), "<i4").reshape(n, dim)
        self.norm = np.frombuffer(get("norm").as_py(), "<f8")
        self.angle = np.frombuffer(get("angle").as_py(), "<f8").reshape(n, -1)
        self.positives = get("positives").as_py()


def score_bounds(a: Block, i: int, rows: Block, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of anchor i with some rows."""
    mine, theirs = a.angle[i], rows.angle[which]
    size = a.norm[i] * rows.norm[which]
    if theirs.shape[1]:
        least = np.abs(theirs - mine).max(axis=1) - SLACK
        most = np.minimum(theirs + mine, 2 * np.pi - theirs - mine).min(axis=1) + SLACK
        lower, upper = np.cos(np.minimum(most, np.pi)), np.cos(np.maximum(least, 0.0))
    else:
        lower, upper = np.full(len(which), -1.0), np.ones(len(which))
    room = 1e-9 * size + 1e-6
    return np.floor(lower * size - room), np.ceil(upper * size + room)


def exact_scores(a: Block, i: int, rows: Block, which: np.ndarray) -> np.ndarray:
    if len(which) and a.norm[i] * rows.norm[which].max() < float(1 << 52):
        return (rows.vec[which].astype(np.float64) @ a.vec[i].astype(np.float64)).astype(np.int64)
    return rows.vec[which].astype(np.int64) @ a.vec[i].astype(np.int64)


def first(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n first by falling score, equal ones by id."""
    if len(scores) > n:
        keep = np.flatnonzero(scores >= np.partition(scores, -n)[-n])
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:n]


def window(p: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest score s with low * p <= 100 * s <= high * p."""
    return -((-low * p) // 100), (high * p) // 100


def block_positives(a: Block, rows: Block, k: int) -> tuple[list, int]:
    """(anchor, row, score) of the block's k best rows of each anchor's label,
    and how many pairs were scored."""
    out, scored = [], 0
    order = np.argsort(rows.label, kind="stable")
    labels = rows.label[order]
    for i in range(len(a.ids)):
        s, e = np.searchsorted(labels, a.label[i], "left"), np.searchsorted(labels, a.label[i], "right")
        which = order[s:e]
        which = which[rows.ids[which] != a.ids[i]]
        if not len(which):
            continue
        lower, upper = score_bounds(a, i, rows, which)
        if len(which) > k:
            which = which[upper >= np.partition(lower, -k)[-k]]
        score = exact_scores(a, i, rows, which)
        scored += len(which)
        for j in first(rows.ids[which], score, k).tolist():
            out.append((int(a.ids[i]), int(rows.ids[which[j]]), int(score[j])))
    return out, scored


def block_negatives(a: Block, rows: Block, n: int, low: int, high: int) -> tuple[list, int]:
    """(anchor, its window's positive score, row, score) of the block's first n
    rows in each window of every anchor, and how many pairs were scored."""
    out, scored = [], 0
    for i in range(len(a.ids)):
        wanted = [(p, *window(p, low, high)) for p in sorted(set(a.positives[i]))]
        wanted = [(p, lo, hi) for p, lo, hi in wanted if lo <= hi]
        if not wanted:
            continue
        which = np.flatnonzero(rows.label != a.label[i])
        lower, upper = score_bounds(a, i, rows, which)
        near = np.zeros(len(which), bool)
        for _, lo, hi in wanted:
            inside = (upper >= lo) & (lower <= hi)
            sure = lower[(lower >= lo) & (upper <= hi)]          # rows that certainly lie in the window
            if len(sure) >= n:
                inside &= upper >= np.partition(sure, -n)[-n]
            near |= inside
        which = which[near]
        score = exact_scores(a, i, rows, which)
        scored += len(which)
        order = np.argsort(-score, kind="stable")               # rows stand in ascending vec_id
        falling = -score[order]
        for p, lo, hi in wanted:
            s, e = np.searchsorted(falling, -hi, "left"), np.searchsorted(falling, -lo, "right")
            for j in order[s:min(e, s + n)].tolist():
                out.append((int(a.ids[i]), p, int(rows.ids[which[j]]), int(score[j])))
    return out, scored


def _meet(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, work, schema: str) -> DataFrame:
    """``work(anchor table, row table)`` for each anchor block with each row block."""
    every = lambda df, own, other, n: df.withColumnRenamed("blk", own).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    left, right = every(anchors, "ab", "rb", n_rows), every(rows, "rb", "ab", n_anchors)
    return left.groupBy("ab", "rb").cogroup(right.groupBy("ab", "rb")).applyInArrow(work, schema)


def _columns(found: list, names: list[str]) -> pa.Table:
    return pa.table([pa.array([f[c] for f in found], pa.int64()) for c in range(len(names))], names=names)


def _positives(dim: int, k: int):
    def run(a: pa.Table, r: pa.Table) -> pa.Table:
        found = block_positives(Block(a, dim), Block(r, dim), k)[0] if a.num_rows and r.num_rows else []
        return _columns(found, ["anchor_id", "positive_id", "positive_score"])
    return run


def _negatives(dim: int, n: int, low: int, high: int):
    def run(a: pa.Table, r: pa.Table) -> pa.Table:
        found = block_negatives(Block(a, dim), Block(r, dim), n, low, high)[0] if a.num_rows and r.num_rows else []
        return _columns(found, ["anchor_id", "positive_score", "negative_id", "negative_score"])
    return run


def mine(rows: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         references: int = REFERENCES, rows_a_block: int = ROWS, anchors_a_block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score over ``rows(vec_id, embedding, label)``."""
    spark = rows.sparkSession
    vecs = written(vectors(rows), "hardneg-vectors")
    n, n_anchor, dim = vecs.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("vec_id") % anchor_every == 0).cast("int")), F.lit(0)),
                                F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    directions = reference_directions(vecs, dim, references)
    # smaller blocks where there would be fewer than tasks, down to a quarter: each returns its own best few
    n_rows = max(1, -(-n // rows_a_block), min(mixed_partitions(spark), -(-4 * n // rows_a_block)))
    n_anchors = max(1, -(-n_anchor // anchors_a_block))
    row_blocks = written(_blocks(vecs, n_rows, directions, dim), "hardneg-rows")
    anchors = vecs.where(F.col("vec_id") % anchor_every == 0)
    best = _meet(_blocks(anchors, n_anchors, directions, dim), row_blocks, n_anchors, n_rows, _positives(dim, positives),
                 "anchor_id bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = written(best.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives).drop("n"), "hardneg-positives")
    own = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("positives"))   # at most ``positives`` values
    found = _meet(_blocks(anchors.join(own, "vec_id"), n_anchors, directions, dim, with_windows=True), row_blocks, n_anchors, n_rows,
                  _negatives(dim, negatives, low, high), "anchor_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.join(best, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE_SQL = """
WITH fine AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
      FROM fine a JOIN fine r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
