"""Exact top-k by inner product of non-negative sparse vectors, with upper bounds.

Ids are ordered by their heaviest terms, so that ids which share them stand
together, and packed into blocks of bounded size (one row each: ids, term
numbers, weights). Inside a block, runs of ``RUN`` ids carry the largest weight
of every term. For a seed and a run, the sum over the seed's terms of its weight
times that maximum bounds every score in the run; a run whose bound is below the
seed's k-th best score known so far is never scored.

1. Every block is scored against itself first: a seed's k-th best score there,
   among ids like itself, is a lower bound of its k-th best overall and travels
   with the block (only where seeds and items are the same ids).
2. Each seed block meets all item blocks in a Cartesian product that reads both
   tables of blocks (nothing is copied or shuffled). A task takes a seed block
   through its part of the item blocks and keeps each seed's k best so far, whose
   last one is the bound for the next blocks. Rare terms are added pair by pair;
   for the terms that most of the block holds the bounds decide which runs are
   multiplied at all. Without a bound from step 1 the runs with the largest
   bounds are scored first, and the k-th best of those is taken.
3. A seed block emits its k candidates a seed for every part of the item blocks
   (``PART`` entries), and how many (seed, run) cells there were and how many
   were scored; a last ranking merges the candidates.

Scores are rounded to 12 decimals before they are compared, here and in the join
on terms that takes the ids with more than ``hot_rows`` entries (those would not
fit a block).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.functions.ranking import global_rank, top_k_per_group
from cinelake.operators.similarity import HOT_ROWS, _sparse_add, _term_join
from cinelake.session import written

ROWS = 2048                  # ids of a block, about
ENTRIES = 2_000_000          # entries of a block, at most (or one id)
RUN = 16                     # neighbouring ids that share one bound
SPARSE_COST = 300            # cost of one expanded pair of entries relative to one dense multiply-add
PART = 8_000_000             # entries of a part of the item blocks, about
HELD = 4_000_000             # entries of the item blocks that a task keeps decoded
FEW = 16                     # cells per expanded pair from which pairs are sorted instead of spread out
DENSE_TERMS = 4096           # dense terms whose bounds are held together
HEAVY = 4                    # heaviest terms that order the ids
DP = 12
SLACK = 1e-9

_BLOCK = "part bigint, ids array<bigint>, sizes array<int>, terms binary, weights binary, gone_sizes array<int>, gone binary, least binary"
_OUT = "sid bigint, iid bigint, sim double, cells bigint, scored bigint"


def numbered_terms(seeds: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with integer terms: strings by their 64-bit hash if no two of
    them share one (counted), else by their rank."""
    if isinstance(items.schema["term"].dataType, T.IntegralType):
        return seeds, items
    same = seeds is items
    terms = items.select("term")
    terms = (terms if same else terms.unionByName(seeds.select("term"))).distinct()
    n, hashes = terms.agg(F.count(F.lit(1)), F.countDistinct(F.xxhash64("term"))).first()
    if n == hashes:
        number = lambda df: df.select("id", F.xxhash64("term").alias("term"), "w")
    else:
        ranks = global_rank(terms, [F.col("term").asc()], rank_col="_t")
        number = lambda df: df.join(ranks, "term").select("id", F.col("_t").alias("term"), "w")
    items = number(items)
    return (items if same else number(seeds)), items


def _vectors(normalize: bool):
    """Per id: entries of a term added up, zeros dropped, unit length if asked
    for, terms ascending; and the heaviest terms."""
    def run(batches):
        for batch in batches:
            rows = batch.column("v")
            size = np.diff(np.asarray(rows.offsets))
            flat = rows.flatten()
            terms, w = np.asarray(flat.field("term")), np.asarray(flat.field("w"))
            owner = np.repeat(np.arange(len(rows)), size)
            order = np.lexsort((terms, owner))
            owner, terms, w = owner[order], terms[order], w[order]
            first = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(terms, prepend=0) != 0))
            w = np.add.reduceat(w, first) if len(first) else w
            owner, terms = owner[first], terms[first]
            keep = w != 0
            owner, terms, w = owner[keep], terms[keep], w[keep]
            if normalize:
                w = w / np.sqrt(np.bincount(owner, w * w, len(rows)))[owner]
            count = np.bincount(owner, minlength=len(rows))
            bounds = np.concatenate([[0], np.cumsum(count)])
            heavy = np.lexsort((terms, -w, owner))
            place = np.arange(len(owner)) - np.repeat(bounds[:-1], count)
            top = place < HEAVY
            has = np.flatnonzero(count)
            lists = lambda x, n: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), lists(terms, count), lists(w, count), lists(terms[heavy][top], np.minimum(count, HEAVY)), batch.column("gone")],
                names=["id", "terms", "weights", "heavy", "gone"]).take(pa.array(has))
    return run


def _pack(rows: int, entries: int):
    def emit(held, number):
        part = (TaskContext.get().partitionId() << 32) + number
        ids, terms, weights, gone = (pa.concat_arrays([b.column(c) for b in held]) for c in ("id", "terms", "weights", "gone"))
        size, gone_size = (np.diff(np.asarray(x.offsets)) for x in (terms, gone))
        one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(x, kind))
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), one(ids, pa.int64()), one(size, pa.int32()), pa.array([np.asarray(terms.flatten()).astype("<i8").tobytes()], pa.binary()),
             pa.array([np.asarray(weights.flatten()).astype("<f8").tobytes()], pa.binary()), one(gone_size, pa.int32()),
             pa.array([np.asarray(gone.flatten()).astype("<i8").tobytes()], pa.binary()), pa.array([b""], pa.binary())],
            names=["part", "ids", "sizes", "terms", "weights", "gone_sizes", "gone", "least"])

    def run(batches):
        held, n, total, number = [], 0, 0, 0
        for batch in batches:
            size = np.diff(np.asarray(batch.column("terms").offsets)) + np.diff(np.asarray(batch.column("gone").offsets))
            at = 0
            while at < batch.num_rows:
                room = np.flatnonzero(np.cumsum(size[at:at + rows - n]) + total > entries)
                take = int(room[0]) if len(room) else min(rows - n, batch.num_rows - at)
                if not take and not n:
                    take = 1                                      # one id of very many entries
                if take:
                    held.append(batch.slice(at, take))
                    n, total, at = n + take, total + int(size[at:at + take].sum()), at + take
                if n >= rows or len(room) or total > entries:
                    yield emit(held, number)
                    held, n, total, number = [], 0, 0, number + 1
        if held:
            yield emit(held, number)
    return run


class Block:
    def __init__(self, row: dict):
        self.ids, size = np.asarray(row["ids"], np.int64), np.asarray(row["sizes"], np.int64)
        self.row = np.repeat(np.arange(len(self.ids)), size)
        self.term, self.w = np.frombuffer(row["terms"], "<i8"), np.frombuffer(row["weights"], "<f8")
        self.least = np.frombuffer(row["least"], "<f8") if row.get("least") else np.zeros(len(self.ids))
        self.terms, self.code = np.unique(self.term, return_inverse=True)
        self.order = np.argsort(self.ids)


def _common(s: Block, i: Block) -> tuple[int, np.ndarray, np.ndarray]:
    """How many terms both have, and each entry's number among them (or -1)."""
    at = np.minimum(np.searchsorted(i.terms, s.terms), max(len(i.terms) - 1, 0))
    hit = (i.terms[at] == s.terms) if len(i.terms) else np.zeros(len(s.terms), bool)
    n = int(hit.sum())
    of_s, of_i = np.where(hit, np.cumsum(hit) - 1, -1), np.full(len(i.terms), -1)
    of_i[at[hit]] = np.arange(n)
    return n, of_s[s.code], of_i[i.code]


def _few_pairs(ni: int, s_row, sc, sw, i_row, ic, iw, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, sum of products) of the cells with a shared term, in order."""
    order = np.argsort(ic, kind="stable")
    count = np.bincount(ic, minlength=n)
    start = np.cumsum(count) - count
    reps = count[sc]
    e = np.repeat(np.arange(len(sc)), reps)
    j = order[start[sc[e]] + np.arange(len(e)) - np.repeat(np.cumsum(reps) - reps, reps)]
    cell, place = np.unique(s_row[e] * ni + i_row[j], return_inverse=True)
    return cell, np.bincount(place, weights=sw[e] * iw[j], minlength=len(cell))


@dataclass
class Found:
    seed: np.ndarray             # positions in the seed block
    item: np.ndarray
    sim: np.ndarray
    cells: int                   # (seed, run) cells, and how many of them were scored
    scored: int


def _kth(sim: np.ndarray, k: int) -> np.ndarray:
    """Each row's k-th largest value; 0 where there are fewer columns."""
    if sim.shape[1] < k:
        return np.zeros(len(sim))
    return np.partition(sim, sim.shape[1] - k, axis=1)[:, sim.shape[1] - k]


def _dense(block: Block, of: np.ndarray, n: int) -> np.ndarray:
    held = of >= 0
    out = np.zeros((len(block.ids), n))
    out[block.row[held], of[held]] = block.w[held]
    return out


def score_blocks(s: Block, i: Block, k: int, masked: tuple[np.ndarray, np.ndarray], least: np.ndarray, first_pass: bool = False) -> Found:
    """Candidates of a block pair: per seed every item that may be among its k
    best, given ``least``, a lower bound of its k-th best score. ``masked``:
    pairs (seed position, item position) that never count."""
    ns, ni = len(s.ids), len(i.ids)
    n_common, sc, ic = _common(s, i)
    n_runs = -(-ni // RUN)
    nothing = Found(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), ns * n_runs, 0)
    if not n_common:
        return nothing
    a, b = (np.bincount(c[c >= 0], minlength=n_common).astype(np.float64) for c in (sc, ic))
    sparse = a * b * SPARSE_COST < float(ns) * ni
    dense_number = np.where(sparse, -1, np.cumsum(~sparse) - 1)
    n_dense = int((~sparse).sum())
    rare = None
    ms, mi = (sc >= 0) & sparse[sc], (ic >= 0) & sparse[ic]
    if not n_dense and float(a @ b) * FEW < float(ns) * ni:
        cell, sim = _few_pairs(ni, s.row[ms], sc[ms], s.w[ms], i.row[mi], ic[mi], i.w[mi], n_common)
        keep = (sim > 0) & (sim >= least[cell // ni] - SLACK)
        if len(masked[0]):
            keep &= ~np.isin(cell, masked[0] * ni + masked[1])
        return Found(cell[keep] // ni, cell[keep] % ni, sim[keep], ns * n_runs, ns * n_runs)
    if ms.any():
        flat = np.zeros(ns * ni)
        _sparse_add(flat, ni, s.row[ms], sc[ms], s.w[ms], i.row[mi], ic[mi], i.w[mi], n_common)
        rare = flat.reshape(ns, ni)
    if not n_dense:
        if len(masked[0]):
            rare[masked] = -1.0
        near = least if not first_pass else np.maximum(least, _kth(rare, k))
        at = np.flatnonzero((rare.ravel() > 0) & (rare >= (near - SLACK)[:, None]).ravel())
        return Found(at // ni, at % ni, rare.ravel()[at], ns * n_runs, ns * n_runs)
    if n_dense > DENSE_TERMS:                                       # bounds would cost more than they save: all runs, chunk by chunk of terms
        sim = rare if rare is not None else np.zeros((ns, ni))
        for lo in range(0, n_dense, DENSE_TERMS):
            part = lambda c: np.where((c >= 0) & (dense_number[c] >= lo) & (dense_number[c] < lo + DENSE_TERMS), dense_number[c] - lo, -1)  # noqa: E731, B023
            sim += _dense(s, part(sc), DENSE_TERMS) @ _dense(i, part(ic), DENSE_TERMS).T
        if len(masked[0]):
            sim[masked] = -1.0
        near = np.maximum(least, _kth(sim, k)) if first_pass else least
        at = np.flatnonzero((sim > 0).ravel() & (sim >= (near - SLACK)[:, None]).ravel())
        return Found(at // ni, at % ni, sim.ravel()[at], ns * n_runs, ns * n_runs)
    number = lambda c: np.where(c >= 0, dense_number[c], -1)
    left, right = _dense(s, number(sc), n_dense), _dense(i, number(ic), n_dense)
    starts = np.arange(0, ni, RUN)
    bound = left @ np.maximum.reduceat(right, starts, axis=0).T
    if rare is not None:
        bound += np.maximum.reduceat(rare, starts, axis=1)
    mask_of: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    if len(masked[0]):
        order = np.argsort(masked[1], kind="stable")
        row, col = masked[0][order], masked[1][order]
        cuts = np.searchsorted(col, np.append(starts, ni))
        mask_of = {r: (row[x:y], col[x:y] - starts[r]) for r, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if y > x}
    near = least.copy()
    seeds, items, sims, scored = [], [], [], 0

    def score(r: int, who: np.ndarray) -> np.ndarray:
        a0, a1 = starts[r], min(starts[r] + RUN, ni)
        sim = (left if len(who) == ns else left[who]) @ right[a0:a1].T
        if rare is not None:
            sim += rare[who, a0:a1]
        if r in mask_of:
            row, col = mask_of[r]
            at = np.searchsorted(who, row)
            hit = (at < len(who)) & (who[np.minimum(at, len(who) - 1)] == row)
            sim[at[hit], col[hit]] = -1.0
        return sim

    def take(who: np.ndarray, sim: np.ndarray, at: int):
        row, col = np.nonzero((sim > 0) & (sim >= (near[who] - SLACK)[:, None]))
        seeds.append(who[row])
        items.append(col + at)
        sims.append(sim[row, col])

    todo = np.arange(n_runs)
    if first_pass:                                                  # the runs with the largest bounds set the first k-th best
        order = np.argsort(-bound.sum(axis=0), kind="stable")
        lead = order[:max(2, -(-4 * k // RUN))]
        everyone = np.arange(ns)
        got = [(int(starts[r]), score(int(r), everyone)) for r in lead.tolist()]
        near = np.maximum(near, np.maximum(_kth(np.concatenate([g for _, g in got], axis=1), k), 0.0))
        for at, sim in got:
            take(everyone, sim, at)
        scored += ns * len(lead)
        todo = order[len(lead):]
    for r in todo.tolist():
        who = np.flatnonzero((bound[:, r] >= near - SLACK) & (bound[:, r] > 0))
        if len(who):
            scored += len(who)
            take(who, score(r, who), int(starts[r]))
    return Found(np.concatenate(seeds) if seeds else nothing.seed, np.concatenate(items) if items else nothing.item,
                 np.concatenate(sims) if sims else nothing.sim, ns * n_runs, scored)


def _own(ids: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in ids, in others) of the ids that both have."""
    both, a, b = np.intersect1d(ids, others, return_indices=True)
    return a, b


def _lower_bounds(k: int, exclude_self: bool):
    """Each block with its seeds' k-th best scores against the block itself."""
    def run(batches):
        for batch in batches:
            least = []
            for row in batch.to_pylist():
                b = Block(row)
                none = np.zeros(0, np.int64)
                found = score_blocks(b, b, k, _own(b.ids, b.ids) if exclude_self else (none, none), np.zeros(len(b.ids)), first_pass=True)
                order = np.lexsort((-found.sim, found.seed))
                seed, sim = found.seed[order], found.sim[order]
                at = np.searchsorted(seed, np.arange(len(b.ids)), "left") + k - 1
                end = np.searchsorted(seed, np.arange(len(b.ids)), "right")
                least.append(np.where(at < end, sim[np.minimum(at, max(len(sim) - 1, 0))] if len(sim) else 0.0, 0.0).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in batch.schema.names[:-1]] + [pa.array(least, pa.binary())], names=batch.schema.names)
    return run


class Seeds:
    """A seed block on its way through item blocks: each seed's k best so far."""

    def __init__(self, row: dict, k: int):
        self.block, self.k = Block(row), k
        self.near = self.block.least.copy()
        size, gone = np.asarray(row["gone_sizes"], np.int64), np.frombuffer(row["gone"], "<i8")
        order = np.argsort(gone, kind="stable")
        self.gone, self.goer = gone[order], np.repeat(np.arange(len(size)), size)[order]
        self.seed, self.iid, self.sim = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.met = self.cells = self.scored = 0
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_new = 0

    def masked(self, i: Block, exclude_self: bool) -> tuple[np.ndarray, np.ndarray]:
        """(seed position, item position) of the pairs that never count."""
        parts = [_own(self.block.ids, i.ids)] if exclude_self else []
        if len(self.gone):
            ids = i.ids[i.order]
            lo, hi = np.searchsorted(self.gone, ids, "left"), np.searchsorted(self.gone, ids, "right")
            n = hi - lo
            at = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            parts.append((self.goer[at], np.repeat(i.order, n)))
        return tuple(np.concatenate([p[x] for p in parts]) if parts else np.zeros(0, np.int64) for x in (0, 1))

    def meet(self, i: Block, exclude_self: bool) -> None:
        found = score_blocks(self.block, i, self.k, self.masked(i, exclude_self), self.near, first_pass=not self.met and not (self.near > 0).all())
        sim = np.round(found.sim, DP)
        keep = sim > 0
        self.new.append((found.seed[keep], i.ids[found.item[keep]], sim[keep]))
        self.n_new += int(keep.sum())
        self.cells, self.scored = self.cells + found.cells, self.scored + found.scored
        if not self.met or 2 * self.n_new > self.k * len(self.near):
            self.settle()
        self.met += 1

    def settle(self) -> None:
        seed, iid, sim = (np.concatenate([x, *(n[c] for n in self.new)]) for c, x in enumerate((self.seed, self.iid, self.sim)))
        order = np.lexsort((iid, -sim, seed))
        seed = seed[order]
        place = np.arange(len(seed)) - np.searchsorted(seed, seed, "left")
        top = place < self.k
        self.seed, self.iid, self.sim = seed[top], iid[order][top], sim[order][top]
        last = place[top] == self.k - 1
        self.near[self.seed[last]] = np.maximum(self.near[self.seed[last]], self.sim[last])
        self.new, self.n_new = [], 0

    def rows(self) -> pa.RecordBatch:
        self.settle()
        n = len(self.seed)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(self.block.ids[self.seed], 0).astype(np.int64)), pa.array(np.append(self.iid, 0).astype(np.int64), mask=np.arange(n + 1) == n),
             pa.array(np.append(self.sim, 0.0).astype(np.float64)), pa.array([0] * n + [self.cells], pa.int64()), pa.array([0] * n + [self.scored], pa.int64())],
            names=["sid", "iid", "sim", "cells", "scored"])


def _meet(k: int, exclude_self: bool):
    """Rows are pairs of blocks, those of a seed block one after the other."""
    def run(batches):
        seeds, part, items, held = None, None, {}, 0
        for batch in batches:
            names = batch.schema.names
            for r in range(batch.num_rows):
                cell = lambda c: batch.column(names.index(c))[r].as_py()  # noqa: E731, B023
                if cell("s_part") != part:
                    if seeds is not None:
                        yield seeds.rows()
                    part = cell("s_part")
                    seeds = Seeds({c: cell(f"s_{c}") for c in ("ids", "sizes", "terms", "weights", "gone_sizes", "gone", "least")}, k)
                at = cell("i_part")
                if at not in items:
                    if held > HELD:
                        items, held = {}, 0
                    items[at] = Block({c: cell(f"i_{c}") for c in ("ids", "sizes", "terms", "weights")})
                    held += len(items[at].term)
                seeds.meet(items[at], exclude_self)
        if seeds is not None:
            yield seeds.rows()
    return run


def _blocks(vecs: DataFrame, n_ids: int, n_rows: int, normalize: bool, rows_a_block: int, exclude: DataFrame | None = None) -> DataFrame:
    parts = max(1, math.ceil(n_ids / rows_a_block), math.ceil(n_rows / ENTRIES))
    one = vecs.groupBy("id").agg(F.collect_list(F.struct(F.col("term").cast("bigint").alias("term"), F.col("w").cast("double").alias("w"))).alias("v"))
    one, none = one.withColumn("id", F.col("id").cast("bigint")), F.array().cast("array<bigint>")
    if exclude is None:
        one = one.withColumn("gone", none)
    else:
        gone = exclude.groupBy(F.col("sid").cast("bigint").alias("id")).agg(F.collect_list(F.col("iid").cast("bigint")).alias("gone"))
        one = one.join(gone, "id", "left").withColumn("gone", F.coalesce("gone", none))
    rows = one.select("id", "v", "gone").mapInArrow(
        _vectors(normalize), "id bigint, terms array<bigint>, weights array<double>, heavy array<bigint>, gone array<bigint>")
    rows = rows.repartitionByRange(parts, "heavy", "id").sortWithinPartitions("heavy", "id").select("id", "terms", "weights", "gone")
    return rows.mapInArrow(_pack(rows_a_block, ENTRIES), _BLOCK)


def candidates(seeds: DataFrame, items: DataFrame, k: int, *, exclude: DataFrame | None = None, exclude_self: bool = True,
               normalize: bool = True, rows_a_block: int = ROWS, hot_rows: int = HOT_ROWS, stored: bool = False) -> DataFrame:
    """(sid, iid, sim, cells, scored), written: candidates among which are every
    seed's k best, and for every block pair a row without ``iid`` that counts its
    (seed, run) cells and those that were scored. ``stored``: the vectors are
    tables already, which may be read several times."""
    same = seeds is items
    whole = lambda df: df.where(F.col("id").isNotNull() & F.col("term").isNotNull() & F.col("w").isNotNull())
    keep = (lambda df, name: whole(df)) if stored else (lambda df, name: written(whole(df), name))
    seeds = keep(seeds, "topk-seeds")
    items = seeds if same else keep(items, "topk-items")
    seeds, items = numbered_terms(seeds, items)
    sizes = lambda df: df.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    shape = lambda df: df.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    shapes = {side: shape(sizes(df)) for side, df in (("s", seeds), ("i", items)) if side == "s" or not same}
    shapes.setdefault("i", shapes["s"])
    apart = []
    if max(shapes["s"][2], shapes["i"][2]) > hot_rows:                # ids that would not fit a block
        from cinelake.operators.similarity import l2_normalize
        unit = lambda df: l2_normalize(df) if normalize else df
        whole_s = written(unit(seeds), "topk-unit-seeds")
        whole_i = whole_s if same else written(unit(items), "topk-unit-items")
        hot = lambda df: df.select("id").join(sizes(df).where(F.col("n") > hot_rows).select("id"), "id", "left_semi").distinct()
        hot_s, hot_i = written(hot(seeds), "topk-hot-seeds"), written(hot(items), "topk-hot-items")
        apart = [_term_join(whole_s.join(hot_s, "id", "left_semi"), whole_i, exclude, exclude_self, 0.0),
                 _term_join(whole_s.join(hot_s, "id", "left_anti"), whole_i.join(hot_i, "id", "left_semi"), exclude, exclude_self, 0.0)]
        seeds, items = seeds.join(hot_s, "id", "left_anti"), items.join(hot_i, "id", "left_anti")
    left = _blocks(seeds, shapes["s"][0], shapes["s"][1], normalize, rows_a_block, exclude)
    if same:
        left = right = written(left.mapInArrow(_lower_bounds(k, exclude_self), _BLOCK), "topk-blocks")
    else:
        left = written(left, "topk-seed-blocks")
        right = written(_blocks(items, shapes["i"][0], shapes["i"][1], normalize, rows_a_block), "topk-item-blocks")
    left = left.select(*[F.col(c).alias(f"s_{c}") for c in left.columns])
    right = right.select(*[F.col(c).alias(f"i_{c}") for c in ("part", "ids", "sizes", "terms", "weights")]).coalesce(math.ceil(max(shapes["i"][1], 1) / PART))
    found = left.hint("shuffle_replicate_nl").crossJoin(right).mapInArrow(_meet(k, exclude_self), _OUT)
    for pairs in apart:
        found = found.unionByName(pairs.select("sid", "iid", "sim", F.lit(0).cast("bigint").alias("cells"), F.lit(0).cast("bigint").alias("scored")))
    return written(found, "topk-candidates")


def pruned_topk(seeds: DataFrame, items: DataFrame, k: int, **options) -> DataFrame:
    """(sid, iid, sim, rank): the k items of largest score above 0 for each seed
    (``seeds`` and ``items``: (id, term, w) with no negative w; cosine unless
    ``normalize=False``), equal scores by id. ``exclude``: pairs (sid, iid) that
    are never returned."""
    found = candidates(seeds, items, k, **options).where(F.col("iid").isNotNull()).select("sid", "iid", "sim")
    return top_k_per_group(found, "sid", k, [F.col("sim").desc(), F.col("iid").asc()])


def pruned_share(found: DataFrame) -> DataFrame:
    """(cells, scored, pruned): of the candidates' (seed, run) cells, the share
    that was never scored."""
    a = found.agg(F.sum("cells").alias("cells"), F.sum("scored").alias("scored"))
    return a.select("cells", "scored", (1 - F.col("scored") / F.col("cells")).alias("pruned"))
