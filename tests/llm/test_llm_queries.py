"""The registered queries against SQL, brute force, round trips and held-out labels."""

import os
import sys
import zlib

import duckdb
import llm_brute as brute
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cinelake.llm import line_dedup, quality, queries
from cinelake.llm.common import BPE

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from oracle_check import compare, duck  # noqa: E402


@pytest.fixture(scope="module")
def documents(sf):
    return duckdb.sql(f"SELECT doc_id, text, source, lang FROM '{sf}/documents.parquet' ORDER BY 1").fetchall()


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(BPE)
    return t


def token_ids(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf, key):
    df = queries.QUERIES[key](spark, sf)
    rows = [r.asDict(recursive=True) for r in df.collect()]
    cur = duck(sf).execute(queries.ORACLE_SQL[key])
    cols = [d[0] for d in cur.description]
    ok, msg = compare(rows, df.columns, [dict(zip(cols, r)) for r in cur.fetchall()], cols)
    assert ok, msg


def test_token_file(spark, sf, documents, tokenizer):
    got = {r.doc_id: r for r in queries.op1_token_file(spark, sf).collect()}
    assert len(got) == len(documents)
    at = 0
    for d, text, *_ in documents:
        ids = token_ids(tokenizer, text, 0)
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def check_pieces(pieces, ids_of):
    """Every id in exactly one piece; sequences gapless and at most 2048 long."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = ids_of[p["doc_id"]]
        assert p["doc_tokens"] == len(ids)
        assert p["ids_crc32"] == zlib.crc32(ids[p["start"]:p["start"] + p["length"]].tobytes())
        by_doc.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert set(by_doc) == set(ids_of)
    for spans, total in [(by_doc[d], len(ids_of[d])) for d in by_doc] + [(s, None) for s in by_sequence.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert at == total if total is not None else at <= 2048
    sizes = [sum(n for _, n in s) for s in by_sequence.values()]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    assert padding == 0


def test_packing(spark, sf, documents, tokenizer):
    pieces = [r.asDict() for r in queries.op6_packing(spark, sf).collect()]
    check_pieces(pieces, {d: token_ids(tokenizer, text, 1) for d, text, *_ in documents})


def test_simhash(spark, sf, documents):
    prints = [(d, brute.fingerprint(text)) for d, text, *_ in documents]
    root = brute.components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7_simhash(spark, sf).collect()}
    assert got == {d: (f"{p:016x}", root[p]) for d, p in prints}


def test_decontamination(spark, sf, documents):
    windows = brute.item_windows(duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall())
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in queries.op8_decontamination(spark, sf).collect()}
    assert got == {d: brute.contamination(text, windows) for d, text, *_ in documents}


def test_quality(spark, sf, documents):
    got = {r.doc_id: r.asDict() for r in queries.op10_quality(spark, sf).collect()}
    kept = brute.quality_kept([x[:3] for x in documents], quality.MAX_SHARE, quality.MIN_DOCS, quality.MIN_LEFT)
    for (d, text, *_), keep in zip(documents, kept):
        want = {"doc_id": d, **brute.quality_base(text), "kept": keep}
        assert {k: got[d][k] for k in want} == want


def test_language_held_out(spark, sf, documents):
    got = {r.doc_id: r for r in queries.op5_language(spark, sf).collect()}
    assert set(got) == {x[0] for x in documents}
    for d, *_ in documents:
        assert got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= got[d].score <= 1
    held = [(got[d].lang_pred, lang) for d, text, _, lang in documents if got[d].held_out and lang and len(text or "") > 20]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, sf).collect()}
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(got[d].score, y) for d, y in labels.items() if got[d].held_out]
    assert all(s < 0.3 for s, y in held if y == 0)
    assert sum(s >= 0.3 for s, y in held if y == 1) >= 0.5 * sum(y for _, y in held)


def test_pipeline(spark, sf, documents, tokenizer):
    rows = [x[:3] for x in documents]
    kept = brute.quality_kept(rows, quality.MAX_SHARE, quality.MIN_DOCS, quality.MIN_LEFT)
    rows = [r for r, k in zip(rows, kept) if k]
    rows = [(d, t, s) for (d, _, s), t in zip(rows, brute.cleaned_lines(rows, line_dedup.MAX_RATIO, line_dedup.MIN_PAGES))]
    prints = [(d, brute.fingerprint(t)) for d, t, _ in rows]
    root = brute.components(prints)
    rows = [r for r, (d, p) in zip(rows, prints) if root[p] == d]
    windows = brute.item_windows(duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall())
    rows = [r for r in rows if not brute.contamination(r[1], windows)[-1]]
    pieces = [r.asDict() for r in corpus_pipeline.run(spark, sf).collect()]
    check_pieces(pieces, {d: token_ids(tokenizer, t, 1) for d, t, _ in rows})


def test_stages_return_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).schema == docs.schema
