"""Hard negatives, ranked search and digests against brute force, with edges."""

import hashlib
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from cinelake.llm import bytekernel as bk
from cinelake.llm import digest, hardneg, lexical, queries

EXTRA = ("term", "docs", "blk", "q", "bucket", "ahead", "rank", "score", "n")


# ---- op11

def brute_mine(rows, anchor_every=100, k=5, n=10):
    own = {}
    for v, x, label in rows:
        if v is None or x is None or label is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        q = [math.floor(256 * float(np.float32(c))) for c in x]
        if sum(c * c for c in q) >= 1 << 59:
            continue
        label = int(math.fmod(label + 1, 10)) if math.fmod(v, 7) == 0 else label
        if v not in own or (label, q) < own[v]:
            own[v] = (label, q)
    score = lambda a, b: sum(x * y for x, y in zip(own[a][1], own[b][1]))
    out = []
    for a in own:
        if a % anchor_every:
            continue
        others = [(-score(a, b), b) for b in own if b != a]
        for s, b in sorted(x for x in others if own[x[1]][0] == own[a][0])[:k]:
            fit = sorted(x for x in others if own[x[1]][0] != own[a][0] and 30 * -s <= -100 * x[0] <= 90 * -s)[:n]
            out += [(a, b, i + 1, c, -s, -t) for i, (t, c) in enumerate(fit)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def embeddings(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * len(EXTRA)) for r in rows],
                                 "vec_id bigint, embedding array<float>, label int, " + ", ".join(f"{c} string" for c in EXTRA))


def test_hard_negatives_edges(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.4 * rng.normal(size=8)).tolist(), int(rng.integers(0, 4))) for i in range(600)]
    rows += [rows[100], rows[100], (200, rows[201][1], 0)]                                             # repeated rows, one id twice
    rows += [(1000 + i, [0.25] * 8, i % 3) for i in range(60)]                                         # ties
    rows += [(2000, None, 1), (2001, [1.0, None] + [0.0] * 6, 1), (2002, [float("nan")] * 8, 1), (2100, [float("inf")] * 8, 1),
             (None, [1.0] * 8, 1), (2003, [1.0] * 8, None), (2200, [], 1), (2300, [0.5, 0.5], 2), (2400, [0.0] * 8, 1), (-300, [0.3] * 8, 2),
             (2500, [3.0e38] * 8, 1), (2600, [8.0e5] * 8, 1), (2601, [8.0e5] * 5 + [0.0] * 3, 2),
             (2603, [9.0e5] * 8, 1), (2700, [2.0e6] * 8, 1)]
    want = brute_mine(rows)
    assert len({w[0] for w in want}) > 5 and any(w[5] > 1 << 53 for w in want)
    assert mined(hardneg.mine(embeddings(spark, rows), rows_a_block=64, anchors_a_block=4)) == want
    assert mined(hardneg.mine(embeddings(spark, rows), references=0)) == want
    for few in ([], [(2000, None, 1)], [(100, [1.0], 1)], [(100, [], 1), (1, [], 1)], [(1, [1.0], 1), (2, [1.0], 1)]):
        assert mined(hardneg.mine(embeddings(spark, few))) == brute_mine(few) == []


def test_angles_filter():
    """Near references the bounds leave out most pairs and lose no row."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(16, 32))
    vec = np.floor(256 * (centres[np.arange(1600) % 16] + 0.02 * rng.normal(size=(1600, 32))))
    norm = np.linalg.norm(vec, axis=1)
    block = hardneg.Block.__new__(hardneg.Block)
    block.ids, block.label, block.vec, block.norm = np.arange(1600), np.arange(1600) % 3, vec.astype(np.int64), norm
    block.angle = hardneg.angles(vec, norm, centres / np.linalg.norm(centres, axis=1)[:, None])
    for i in range(0, 1600, 97):
        lower, upper = hardneg.score_bounds(block, i, block, np.arange(1600))
        score = block.vec @ block.vec[i]
        assert (lower <= score).all() and (score <= upper).all()
    found, scored = hardneg.block_positives(block, block, 5)
    assert scored < 0.2 * 1600 * 533
    got = {}
    for a, _, s in found:
        got.setdefault(a, []).append(s)
    for a in range(0, 1600, 131):
        same = (block.label == block.label[a]) & (block.ids != a)
        assert got[a] == sorted((block.vec @ block.vec[a])[same].tolist(), reverse=True)[:5]


# ---- op12

def brute_rank(docs, items, k=10):
    terms = lambda t: re.findall(lexical.TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    bags = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    queries_of = {}
    for i, t in set(items):
        queries_of.setdefault(i, Counter()).update(terms(t))
    out = []
    for i, q in queries_of.items():
        found = []
        for (d, b), size in zip(bags, sizes):
            m = 25 + 75 * size * n // total if total else 0
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t, c in q.items() if t in b)
            if s > 0:
                found.append((-s, d is None, d if d is not None else 0, d))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def ranked(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def texts(spark, rows, name="doc_id"):
    return spark.createDataFrame([(*r, *["clash"] * len(EXTRA)) for r in rows], f"{name} bigint, text string, " + ", ".join(f"{c} string" for c in EXTRA)).repartition(3)


DOCS = ([(i, " ".join(f"w{(i * 7 + j * j) % (3 + j)}" for j in range(i % 23))) for i in range(300)] + [(1000 + i, "Red green-Blue RED") for i in range(30)]
        + [(5, "red"), (5, "red"), (None, "red"), (None, None), (6, ""), (7, " \n,;"), (8, "Ünï-wörd 中文  x ÀB"), (9, "w1 " * 30000)])
ITEMS = [(1, "red w1 w2 w2"), (1, "red w1 w2 w2"), (2, "GREEN w0 w5 w9 w11"), (2, "blue"), (None, "w3 red"), (3, None), (4, ""), (5, "nowhere"),
         (6, "wörd ünï Ünï 中文 àb Àb"), (7, "w1 w2 w3 w4 w5 w6 w7 w8")]


@pytest.mark.parametrize("shape", [{}, {"short": 0.0, "block": 8}, {"short": 1.0, "block": 16}, {"short": 0.05, "block": 4, "packed_bytes": 0}])
def test_search_edges(spark, shape):
    docs, items = texts(spark, DOCS), texts(spark, ITEMS, "item_id")
    terms = lexical.query_terms(items)
    index = lexical.build_index(docs, terms, shard_bytes=2000)
    assert index.count() > 5
    assert ranked(lexical.search(index, terms, **shape)) == brute_rank(DOCS, ITEMS)


def test_search_with_a_whole_index(spark):
    docs, items = texts(spark, DOCS), texts(spark, ITEMS, "item_id")
    terms = lexical.query_terms(items)
    assert ranked(lexical.search(lexical.build_index(docs, terms, max_terms=3), terms, k=3)) == brute_rank(DOCS, ITEMS, 3)
    none = texts(spark, [])
    assert lexical.rank(none, items).count() == 0 and lexical.rank(docs, texts(spark, [], "item_id")).count() == 0


def test_search_skips_blocks():
    """Documents in runs of topics: most blocks lie below the tenth best score."""
    rng = np.random.default_rng(3)
    names = [f"t{i}" for i in range(60)]
    bags = [Counter(rng.choice(60, 20, p=np.roll(np.r_[[0.048] * 20, [0.001] * 40], 20 * (d * 3 // 3000)).tolist())) for d in range(3000)]
    held = [[(d, b[t]) for d, b in enumerate(bags) if t in b] for t in range(60)]
    shard = lexical.Shard(None, np.full(3000, 20), names, np.cumsum([0] + [len(x) for x in held]), np.array([d for x in held for d, _ in x]),
                          np.array([c for x in held for _, c in x]), 3000, 60000, 8)
    query = [(f"t{i}", 100 + i) for i in range(0, 12)]
    best, walked, blocks = shard.best(query, 10)
    full = [sum(w * (10**9 * b[i] // (1000 * b[i] + 8 * 100)) for i, (_, w) in enumerate(query) if i in b) for b in bags]
    assert best == sorted(((s, d) for d, s in enumerate(full)), key=lambda x: (-x[0], x[1]))[:10]
    assert walked < 0.7 * blocks


# ---- op13

def brute_selected(raw, rank):
    count = len(raw) - digest.WIDTH + 1 if len(raw) >= digest.WIDTH else min(len(raw), 1)
    if count <= 1:
        return list(range(count))
    ranks = []
    for i in range(count):
        s = sum(int(digest._SUMS[c]) for c in Counter(raw[i:i + digest.WIDTH]).values())
        ranks.append(int(rank[(int(digest._SUMS[digest.WIDTH]) - s) >> 17]))
    votes = Counter(min(range(i, i + digest.NEAR), key=lambda j: (ranks[j], j)) for i in range(count - digest.NEAR + 1))
    return sorted({i for i, v in votes.items() if v >= digest.VOTES} | {min(range(count), key=lambda j: (ranks[j], j))})


def brute_print(text, rank):
    import xxhash
    raw = text.encode()
    seen, filters = [], []
    for i in brute_selected(raw, rank):
        h = xxhash.xxh64_intdigest(raw[i:i + digest.WIDTH], 0)
        if h not in seen:
            if len(seen) % digest.ITEMS == 0:
                filters.append(0)
            seen.append(h)
            for k in range(digest.HASHES):
                filters[-1] |= 1 << ((h >> (11 * k)) % 2048)
    return filters, len(seen)


def brute_likeness(a, b):
    if a == b:
        return 1.0
    if not a[1] or not b[1]:
        return 0.0
    if (len(b[0]), b[1]) < (len(a[0]), a[1]):
        a, b = b, a
    cut = lambda f, n: f[:-1] if len(f) > 1 and n - 160 * (len(f) - 1) < 16 else f
    best = []
    for f in cut(*a):
        x = [((f & g).bit_count() - f.bit_count() * g.bit_count() / 2048) / max(min(f.bit_count(), g.bit_count()) - f.bit_count() * g.bit_count() / 2048, 1e-9)
             for g in cut(*b)]
        best.append(max(min(v, 1.0) if v > 0.1 else 0.0 for v in x))
    return sum(best) / len(best)


def brute_compare(rows, rank):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, o = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + o[:half]
        own, new, nxt = (brute_print(x, rank) for x in (t, e, o))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), own, new, brute_likeness(own, new), brute_likeness(own, nxt)))
    return sorted(out, key=str)


def digested(df):
    out = []
    for r in df.collect():
        own, new = ((([int.from_bytes(f.tobytes(), "little") for f in x[0]]), x[1]) for x in map(digest.from_text, (r.fingerprint, r.edited_fingerprint)))
        out.append((r.doc_id, r.n_chars, r.edited_sha256, own, new, r.near_edited, r.near_next))
    return sorted(out, key=str)


def same_digests(got, want):
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], atol=1e-12)


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(n))


def test_digest_edges(spark):
    rows = [(i, prose(i, 3 * i)) for i in range(40)] + [(50, prose(50, 2500)), (51, prose(50, 2500)), (60, "ä中😀" * 60), (61, "a" * 500), (62, " "),
            (63, "short"), (64, None), (65, ""), (70, prose(1, 30)), (70, prose(2, 30)), (70, prose(2, 30)), (None, prose(9, 40)), (None, None), (-5, "x" * 31 + "y" * 2)]
    rank = digest.rarity(texts(spark, rows))
    counts = Counter()
    for _, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - 31):
            s = sum(int(digest._SUMS[c]) for c in Counter(raw[i:i + 32]).values())
            counts[(int(digest._SUMS[32]) - s) >> 17] += 1
    order = sorted(range(digest.CLASSES), key=lambda c: (c < digest.LOW_ENTROPY * digest.CLASSES, counts[c], c))
    assert [int(np.flatnonzero(rank == i)[0]) for i in range(digest.CLASSES)] == order
    want = brute_compare(rows, rank)
    same_digests(digested(digest.compare_neighbours(texts(spark, rows))), want)
    own = [w for w in want if w[0] in (50, 51)]
    assert own[0][3] == own[1][3] and 0.3 < own[0][5] < 0.95 and min(w[6] for w in want) == 0.0
    for few in ([], [(1, None)], [(1, prose(1, 50))], [(None, None), (None, "a b c")]):
        same_digests(digested(digest.compare_neighbours(texts(spark, few), rank)), brute_compare(few, rank))


def test_long_pieces(monkeypatch):
    """Pieces of the entropy scan and groups of texts do not show."""
    raw = np.frombuffer(prose(4, 400).encode(), np.uint8)
    whole = digest.window_classes(raw)
    monkeypatch.setattr(digest, "_PIECE", 50)
    assert (digest.window_classes(raw) == whole).all()
    text = bk.text_buffers(__import__("pyarrow").array([raw.tobytes().decode()]))[0]
    assert (digest.window_classes(text) == whole).all()


def test_digest_query(spark, sf):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    short = [r for r in rows if len(r[1]) < 3000]
    got = digested(queries.op13_digest(spark, sf))
    assert len(got) == len(rows)
    rank = digest.rarity(spark.read.parquet(f"{sf}/documents.parquet"))
    prints = {g[0]: g[3] for g in got}
    for d, t in short[:40]:
        assert prints[d] == brute_print(t, rank)
    order = sorted(rows, key=lambda r: -r[0])
    sha = {g[0]: g[2] for g in got}
    for (d, t), (_, o) in zip(order, order[1:] + order[:1]):
        assert sha[d] == hashlib.sha256((t[:len(t) - len(t) // 2] + o[:len(t) // 2]).encode()).hexdigest()
    edited, other = np.array([g[5] for g in got]), np.array([g[6] for g in got])
    assert np.mean(edited > other) > 0.85 and np.median(edited) > 0.3
