"""Exact top-k cosine neighbours over long-form vectors ``(id, term, w)``.

Why not a shared-term self-join: a term held by a large share of the items
(one tag or genre on a third of the catalog) makes the join emit every pair
of those items, which is quadratic in *shuffled rows*.  Here the work is
blocked instead:

* seeds and items are hash-split into ``Bs`` and ``Bi`` blocks of at most
  ``block_size`` ids; every seed row is replicated to the ``Bi`` item blocks
  and every item row to the ``Bs`` seed blocks (replication factor = number of
  blocks, not number of items);
* each (seed block, item block) pair is one cogroup task that scores its
  block with a dense NumPy product, chunked over terms so memory stays
  bounded, and emits only its local top-k per seed;
* a final ``row_number() <= k`` over at most ``Bi * k`` rows per seed merges
  the blocks.

Exclusions (already-seen pairs) travel with the seed side keyed by the block
pair they fall in, so they are never replicated.  The result is exact: every
(seed, item) pair is scored in exactly one task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.ranking import first_k_unseen, global_rank, top_k_per_group
from cinelake.session import cut_lineage, written

DENSE_CELLS = 8_000_000      # max doubles in one term-chunk of a block (64 MB)
MAX_PAIRS = 8_000_000        # max expanded (seed entry, item entry) pairs per step
SPARSE_COST = 300            # cost of one expanded pair relative to one dense multiply-add
OUT_SCHEMA = "sid long, iid long, sim double"
HOT_ROWS = 200_000           # an id with more entries is scored by the term join, not inside a block
MAX_BLOCK_ROWS = 4_000_000   # entries of one side of a block pair, about


def l2_normalize(vecs: DataFrame) -> DataFrame:
    """Rows ``(id, term, w)`` scaled to unit L2 norm per id; zero rows dropped.
    Duplicate (id, term) entries are summed first."""
    v = vecs.groupBy("id", "term").agg(F.sum("w").alias("w")).where(F.col("w") != 0)
    n = v.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"))
    return v.join(n, "id").select("id", "term", (F.col("w") / F.col("n")).alias("w"))


def _sparse_add(sim, ni, s_row, sc, sw, i_row, ic, iw, d) -> None:
    """Add the products of every (seed entry, item entry) pair sharing a term
    into the flat ``sim``; the pair expansion is chunked to MAX_PAIRS."""
    s_ord, i_ord = np.argsort(sc, kind="stable"), np.argsort(ic, kind="stable")
    sc_s = sc[s_ord]
    cb = np.bincount(ic, minlength=d)
    reps_all = cb[sc_s]
    i_start = np.concatenate([[0], np.cumsum(cb)[:-1]])
    cum = np.cumsum(reps_all)
    start = 0
    while start < len(sc_s):
        base = cum[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(cum, base + MAX_PAIRS, side="right")))
        reps = reps_all[start:end]
        p = int(reps.sum())
        if p:
            e = np.repeat(np.arange(start, end), reps)
            within = np.arange(p) - np.repeat(np.cumsum(reps) - reps, reps)
            j = i_start[sc_s[e]] + within
            keys = s_row[s_ord[e]] * ni + i_row[i_ord[j]]
            sim += np.bincount(keys, weights=sw[s_ord[e]] * iw[i_ord[j]], minlength=len(sim))
        start = end


def _dense_add(sim, ns, ni, s_row, sc, sw, i_row, ic, iw, d) -> None:
    """Add dense BLAS products over chunks of terms into ``sim`` (ns, ni)."""
    s_ord, i_ord = np.argsort(sc, kind="stable"), np.argsort(ic, kind="stable")
    sc_s, ic_s = sc[s_ord], ic[i_ord]
    step = max(1, DENSE_CELLS // max(1, ns + ni))
    for lo in range(0, d, step):
        hi = min(d, lo + step)
        a0, a1 = np.searchsorted(sc_s, lo), np.searchsorted(sc_s, hi)
        b0, b1 = np.searchsorted(ic_s, lo), np.searchsorted(ic_s, hi)
        if a0 == a1 or b0 == b1:
            continue
        w = hi - lo
        S = np.bincount(s_row[s_ord[a0:a1]] * w + (sc_s[a0:a1] - lo), weights=sw[s_ord[a0:a1]],
                        minlength=ns * w).reshape(ns, w)
        I = np.bincount(i_row[i_ord[b0:b1]] * w + (ic_s[b0:b1] - lo), weights=iw[i_ord[b0:b1]],
                        minlength=ni * w).reshape(ni, w)
        sim += S @ I.T


def _dot_block(ns, ni, d, s_row, sc, sw, i_row, ic, iw) -> np.ndarray:
    """All seed x item dot products of one block pair as an (ns, ni) array.

    Exact, with the strategy chosen per term by cost: a term held by a_t seed
    entries and b_t item entries costs a_t * b_t expanded pairs sparsely, or
    one ns x ni multiply-add pass densely.  Rare terms (e.g. users as terms of
    item vectors, title words) go through the sparse pair expansion, terms
    shared by most of the block (genres, frequent tags) through dense BLAS
    over term chunks.  Memory is bounded in both: pair expansion and term
    chunks are capped per step.
    """
    ca, cb = np.bincount(sc, minlength=d), np.bincount(ic, minlength=d)
    sparse = ca.astype(np.float64) * cb * SPARSE_COST < float(ns) * ni
    sim = np.zeros(ns * ni)
    ms, mi = sparse[sc], sparse[ic]
    if ms.any() and mi.any():
        _sparse_add(sim, ni, s_row[ms], sc[ms], sw[ms], i_row[mi], ic[mi], iw[mi], d)
    sim = sim.reshape(ns, ni)
    hs, hi = ~ms, ~mi
    if hs.any() and hi.any():
        dense_code = np.cumsum(~sparse) - 1                 # compact codes of the dense terms
        _dense_add(sim, ns, ni, s_row[hs], dense_code[sc[hs]], sw[hs], i_row[hi], dense_code[ic[hi]], iw[hi],
                   int((~sparse).sum()))
    return sim


def _kernel(k: int, exclude_self: bool, min_sim: float, strict: bool):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"sid": pd.Series([], dtype="int64"), "iid": pd.Series([], dtype="int64"),
                              "sim": pd.Series([], dtype="float64")})
        vec = block[block["kind"] == 0]
        ex = block[block["kind"] == 1]
        right = block[block["kind"] == 2].rename(columns={"sid": "iid"})
        if vec.empty or right.empty:
            return empty
        sids, s_row = np.unique(vec["sid"].to_numpy(), return_inverse=True)
        iids, i_row = np.unique(right["iid"].to_numpy(), return_inverse=True)
        codes, uniq = pd.factorize(pd.concat([vec["term"], right["term"]], ignore_index=True))
        sc, ic = codes[: len(vec)], codes[len(vec):]
        sw, iw = vec["w"].to_numpy(dtype="float64"), right["w"].to_numpy(dtype="float64")
        ns, ni, d = len(sids), len(iids), len(uniq)
        sim = _dot_block(ns, ni, d, s_row, sc, sw, i_row, ic, iw)
        simr = np.round(sim, 12)   # near-equal floats tie, then the id decides
        keep = (simr > min_sim) if strict else (simr >= min_sim)
        if exclude_self:
            pos = np.searchsorted(iids, sids)
            hit = (pos < ni) & (iids[np.minimum(pos, ni - 1)] == sids)
            keep[np.nonzero(hit)[0], pos[hit]] = False
        if not ex.empty:
            er = np.searchsorted(sids, ex["sid"].to_numpy())
            ec = np.searchsorted(iids, ex["xid"].to_numpy())
            ok = (er < ns) & (ec < ni)
            er, ec = er[ok], ec[ok]
            ok2 = (sids[er] == ex["sid"].to_numpy()[ok]) & (iids[ec] == ex["xid"].to_numpy()[ok])
            keep[er[ok2], ec[ok2]] = False
        # only entries >= the row's k-th best value can rank: a partial
        # partition per row instead of sorting every scored pair
        simr[~keep] = -np.inf
        if ni > k:
            kth = -np.partition(-simr, k - 1, axis=1)[:, k - 1]
            keep &= simr >= kth[:, None]
        rows, cols = np.nonzero(keep)
        if len(rows) == 0:
            return empty
        vals = simr[rows, cols]
        s_id, i_id = sids[rows], iids[cols]
        order = np.lexsort((i_id, -vals, s_id))
        s_id, i_id, vals = s_id[order], i_id[order], vals[order]
        starts = np.r_[0, np.nonzero(np.diff(s_id))[0] + 1]
        run_len = np.diff(np.r_[starts, len(s_id)])
        rank = np.arange(len(s_id)) - np.repeat(starts, run_len)
        m = rank < k
        return pd.DataFrame({"sid": s_id[m].astype("int64"), "iid": i_id[m].astype("int64"), "sim": vals[m]})
    return run


def _shape(df: DataFrame) -> tuple[int, int]:
    """(distinct ids, rows) of a long-form vector frame, in one job."""
    r = df.agg(F.countDistinct("id").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    return int(r["n"] or 0), int(r["rows"] or 0)


def _block_counts(seeds: DataFrame, items: DataFrame, same: bool, block_size: int) -> tuple[int, int]:
    """Number of seed and item blocks.

    A block pair holds at most ``block_size**2`` (seed, item) cells.  Every
    seed row is replicated to each item block and every item row to each seed
    block, so the shuffled rows are ``S * Ni / y + I * Ns / x`` for seed block
    size x and item block size y with ``x * y = cells``; the minimum is at
    ``y = sqrt(S * Ni * cells / (I * Ns))``.  Equal sides (self similarity)
    give square blocks; a side with many entries per id (user profiles) gets
    smaller blocks so its rows are copied fewer times.
    """
    cells = float(block_size) * block_size
    ns, rs = _shape(seeds)
    ni, ri = (ns, rs) if same else _shape(items)
    if same or not (ns and ni and rs and ri):
        return (max(1, math.ceil(ns / block_size), math.ceil(rs / MAX_BLOCK_ROWS)),
                max(1, math.ceil(ni / block_size), math.ceil(ri / MAX_BLOCK_ROWS)))
    y = min(max(math.sqrt(rs * ni * cells / (ri * ns)), 1.0), float(ni), cells)
    x = min(max(cells / y, 1.0), float(ns))
    y = min(float(ni), cells / x)
    return (max(1, math.ceil(ns / x), math.ceil(rs / MAX_BLOCK_ROWS)),
            max(1, math.ceil(ni / y), math.ceil(ri / MAX_BLOCK_ROWS)))


def _hot_ids(vecs: DataFrame, hot_rows: int) -> DataFrame | None:
    """Ids with more than ``hot_rows`` entries, or None."""
    hot = cut_lineage(vecs.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).select("id"))
    return hot if hot.limit(1).count() else None


def _term_join(seeds: DataFrame, items: DataFrame, exclude: DataFrame | None, exclude_self: bool, min_sim: float) -> DataFrame:
    """(sid, iid, sim) of every pair with a shared term and sim > min_sim."""
    s = seeds.select(F.col("id").cast("long").alias("sid"), "term", F.col("w").cast("double").alias("sw"))
    i = items.select(F.col("id").cast("long").alias("iid"), "term", F.col("w").cast("double").alias("iw"))
    out = s.join(i, "term").groupBy("sid", "iid").agg(F.round(F.sum(F.col("sw") * F.col("iw")), 12).alias("sim")).where(
        F.col("sim") > F.lit(min_sim))
    if exclude_self:
        out = out.where("sid <> iid")
    if exclude is not None:
        out = out.join(exclude.select(F.col("sid").cast("long"), F.col("iid").cast("long")), ["sid", "iid"], "left_anti")
    return out


def blocked_topk(seeds: DataFrame, items: DataFrame, k: int, *, exclude: DataFrame | None = None,
                 exclude_self: bool = True, min_sim: float = 0.0, strict: bool = True,
                 block_size: int = 2048, normalize: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Top-k items per seed by cosine (dot product of unit vectors).

    ``seeds`` / ``items``: ``(id, term, w)``; ``exclude``: ``(sid, iid)`` pairs
    never returned.  Keeps ``sim > min_sim`` (``>=`` when ``strict=False``).
    Output ``(sid, iid, sim, rank)`` ordered by sim desc, iid asc.  Hot ids are
    split off where only pairs with a shared term can rank (``strict`` and
    ``min_sim >= 0``); other callers pass vectors of a fixed number of entries.
    """
    same = seeds is items
    if normalize:
        seeds = l2_normalize(seeds)
        items = seeds if same else l2_normalize(items)
    # the vectors feed the block counts, the replication and the padding step:
    # write them once instead of recomputing their lineage for every consumer
    seeds = cut_lineage(seeds)
    items = seeds if same else cut_lineage(items)
    apart = []
    if strict and min_sim >= 0:
        hot_s = _hot_ids(seeds, hot_rows)
        hot_i = hot_s if same else _hot_ids(items, hot_rows)
        if hot_s is not None:
            apart.append(_term_join(seeds.join(hot_s, "id", "left_semi"), items, exclude, exclude_self, min_sim))
        rest = seeds if hot_s is None else cut_lineage(seeds.join(hot_s, "id", "left_anti"))
        if hot_i is not None:
            apart.append(_term_join(rest, items.join(hot_i, "id", "left_semi"), exclude, exclude_self, min_sim))
        items = (rest if same else items) if hot_i is None or same else cut_lineage(items.join(hot_i, "id", "left_anti"))
        seeds = rest
    bs, bi = _block_counts(seeds, items, same, block_size)
    blk = lambda c, n: F.pmod(F.xxhash64(F.col(c)), F.lit(n)).cast("int")
    # fresh aliases on both sides: seeds and items may be the same frame
    s = seeds.select(F.col("id").cast("long").alias("sid"), F.col("term").alias("term"),
                     F.col("w").cast("double").alias("w"))
    s = s.select(blk("sid", bs).alias("ib"), F.explode(F.sequence(F.lit(0), F.lit(bi - 1))).alias("jb"),
                 F.lit(0).alias("kind"), "sid", "term", "w", F.lit(None).cast("long").alias("xid"))
    if exclude is not None:
        e = exclude.select(F.col("sid").cast("long").alias("sid"), F.col("iid").cast("long").alias("xid"))
        e = e.select(blk("sid", bs).alias("ib"), blk("xid", bi).alias("jb"), F.lit(1).alias("kind"), "sid",
                     F.lit(None).cast(s.schema["term"].dataType).alias("term"), F.lit(None).cast("double").alias("w"),
                     "xid")
        s = s.unionByName(e)
    i = items.select(F.col("id").cast("long").alias("iid"), F.col("term").alias("term"),
                     F.col("w").cast("double").alias("w"))
    i = i.select(F.explode(F.sequence(F.lit(0), F.lit(bs - 1))).alias("ib"), blk("iid", bi).alias("jb"),
                 F.lit(2).alias("kind"), F.col("iid").alias("sid"), "term", "w",
                 F.lit(None).cast("long").alias("xid"))
    # one grouped-map over the union of both sides (kind 0 seed vector,
    # 1 exclusion, 2 item vector): one shuffle on the block pair
    local = (s.unionByName(i).groupBy("ib", "jb")
             .applyInPandas(_kernel(k, exclude_self, min_sim, strict), OUT_SCHEMA))
    for pairs in apart:
        local = local.unionByName(pairs)
    return top_k_per_group(local, "sid", k, [F.col("sim").desc(), F.col("iid").asc()])


def pad_with_zero(topk: DataFrame, seeds: DataFrame, universe: DataFrame, k: int,
                  exclude: DataFrame | None = None, exclude_self: bool = True) -> DataFrame:
    """Complete every seed's list to k rows with similarity-0 items, smallest
    ids first, skipping the seed itself, excluded pairs and items already in
    the list (brute-force kNN returns such rows when too few items are
    similar).  The pads are the k smallest unexcluded ranks of the id-ordered
    universe (``first_k_unseen``), so no seed x universe product is formed."""
    topk = written(topk.select("sid", "iid", "sim"), "topk")       # read three times below
    counts = topk.groupBy("sid").agg(F.count(F.lit(1)).alias("c"))
    short = written(seeds.select("sid").join(counts, "sid", "left").where(F.coalesce("c", F.lit(0)) < k).select("sid"), "topk-short")
    if short.isEmpty():
        return top_k_per_group(topk, "sid", k, [F.col("sim").desc(), F.col("iid").asc()])
    ranked = global_rank(universe.select(F.col("iid").cast("long").alias("iid")).distinct(),
                         [F.col("iid").asc()], rank_col="urank")
    taken = topk.select("sid", "iid").join(short, "sid", "left_semi")
    if exclude is not None:
        taken = taken.unionByName(exclude.select("sid", "iid").join(short, "sid", "left_semi"))
    if exclude_self:
        taken = taken.unionByName(short.select("sid", F.col("sid").alias("iid")))
    taken_r = taken.distinct().join(ranked, "iid").select(F.col("sid").alias("userId"), "urank")
    pads = first_k_unseen(taken_r, short.select(F.col("sid").alias("userId")), k, rank_col="urank")
    pads = pads.join(ranked, "urank").select(F.col("userId").alias("sid"), "iid", F.lit(0.0).alias("sim"))
    both = topk.select("sid", "iid", "sim").unionByName(pads)
    return top_k_per_group(both, "sid", k, [F.col("sim").desc(), F.col("iid").asc()])
