"""Nulls, empty and very long texts, ties, repeated rows, empty tables, extra
columns with clashing names; and cases that the generated tables lack."""

import zlib

import llm_brute as brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cinelake.llm import decontam, language, licenses, line_dedup, packing, quality, rangecoder, simhash, tokenfile, toxicity, warc
from cinelake.llm.common import BPE, PIECES, scratch_path
from cinelake.llm.graph import components

LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(60_000))
CLEAN = " ".join(f"alpha{i} beta{i}" for i in range(40))
EXTRA = ("k1", "k2", "n", "fp", "lines", "hashes", "n_lines", "n_dropped", "n_words", "regions", "digest", "class", "component_id", "_kept")
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (4, LONG, "en", None), (5, CLEAN, "en", "a"),
    (5, CLEAN, "en", "a"), (5, CLEAN + " gamma", "en", "b"), (None, CLEAN, "en", "a"), (None, None, None, None), (6, "one", "en", "b"),
    (7, "!!! ...", "en", "b"), (8, "Ünïcode wörds, 中文字符 and 1234 <|endoftext|> \x00 z", "de", "b"), (9, CLEAN.upper(), "en", "a"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    extra = ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame([r + ("clash",) * len(EXTRA) for r in ROWS], f"{SCHEMA}, {extra}").repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_quality_edges(docs, none):
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
                  for r in quality.judge(docs).collect()), key=str)
    want = []
    for d, text, _, _ in ROWS:
        b = brute.quality_base(text)
        want.append((d, *b.values(), not b["base_failed"]))
    assert got == sorted(want, key=str)
    assert quality.judge(none).count() == 0 and quality.keep_good(none).count() == 0


def test_quality_hash_collisions(spark, monkeypatch):
    """Lines and windows are equal only where their bytes are: a Thue-Morse line
    and its complement share every polynomial hash modulo 2**64."""
    bits = [0]
    while len(bits) < 2048:
        bits += [1 - x for x in bits]
    one, two = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    texts = [f"{one}\n{two}", f"{one}\n{one}", " ".join([one] * 8 + [two] * 8), " ".join([one, two] * 9), "x y\nx  y\nx y \nx y"]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], SCHEMA)).collect()}
    for i, t in enumerate(texts):
        assert {m: getattr(got[i], m) for m in quality._MEASURES} == {m: brute.quality_base(t)[m] for m in quality._MEASURES}
    assert [got[i].n_dup_lines for i in range(5)] == [0, 1, 0, 0, 1]
    plain = quality.bk.window_hashes
    monkeypatch.setattr(quality.bk, "window_hashes", lambda h, k: plain(h, k) % np.uint64(3))       # nearly all windows share a hash
    rng = np.random.default_rng(1)
    rows = [" ".join(rng.choice(["a", "b", "c"], 70)) for _ in range(20)] + [" ".join(f"w{j}" for j in range(50))]
    data, offsets = quality.bk.text_buffers(pa.array(rows))
    assert quality.measure(data, offsets)[0]["n_repeat_words"].tolist() == [brute.quality_base(t)["n_repeat_words"] for t in rows]


def test_quality_cross_document_lines(spark):
    line = "this line stands on every page of the host and says nothing at all to anyone"
    body = [" ".join(f"t{i}x{j}" for j in range(30)) for i in range(20)]
    rows = ([(i, f"{body[i]}\n{line.upper()}", "en", "s") for i in range(12)]                    # good, with the line
            + [(100 + i, f"{line}\nu{i} " + "\n".join([line + f" {i}"] * 0) + "z", "en", "s") for i in range(4)]   # the line alone, almost
            + [(200 + i, body[19], "en", "s") for i in range(15)])                               # copies are one document
    kept = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, SCHEMA), min_words=10).collect()}
    assert all(kept[i] for i in range(12)) and all(kept[200 + i] for i in range(15)) and not any(kept[100 + i] for i in range(4))
    want = brute.quality_kept([(d, t, s) for d, t, _, s in rows], quality.MAX_SHARE, quality.MIN_DOCS, quality.MIN_LEFT)
    assert [kept[d] or brute.quality_base(t)["n_words"] < 20 for d, t, _, _ in rows] == [
        w or brute.quality_base(t)["n_words"] < 20 for w, (_, t, _, _) in zip(want, rows)]


def test_line_dedup_edges(docs, none, spark):
    out = line_dedup.clean_texts(docs, min_pages=3)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
    want = brute.cleaned_lines([(d, t, s) for d, t, _, s in ROWS], line_dedup.MAX_RATIO, 3)
    assert sorted(str((r.doc_id, r.text, r.lang, r.source, r._kept)) for r in out.collect()) == sorted(
        str((d, t, lang, s, "clash")) for (d, _, lang, s), t in zip(ROWS, want))
    assert line_dedup.drop_boilerplate(none).count() == 0
    rows = [(i, f"only {i}\n  footer \n\nfooter", "en", None if i % 2 else "h") for i in range(10)]
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert line_dedup.MIN_PAGES <= 5
    assert got == {i: (f"only {i}\n", 4, 2) for i in range(10)}


def test_simhash_edges(docs, none):
    prints = [(d, brute.fingerprint(t)) for d, t, _, _ in ROWS]
    root = brute.components(prints)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted(((d, f"{p:016x}", root[p]) for d, p in prints), key=str)
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted(simhash.near_duplicates(kept).groupBy("class").count().select("count").distinct().collect()) == [(1,)]
    assert kept.count() == simhash.near_duplicates(docs).select("class").distinct().count()
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_simhash_links_lose_none(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = {0, 2**64 - 1}
    for b in base.tolist():
        for n in (0, 1, 2, 3, 3, 4, 5):
            flip = 0
            for bit in rng.choice(64, n, replace=False).tolist():
                flip |= 1 << bit
            prints.add(b ^ flip)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint")).collect()}
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[i + 1:]
            if 1 <= ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert got == want and len(want) > 100
    rows = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint"))
    assert rows.count() == len(got)                      # each pair once


def test_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 299), (299, 300), (7, 7)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(100 + i, 100) for i in range(30)} | {(299, 299), (300, 299)}


def test_decontamination_edges(docs, none, spark):
    rows = [(1, None), (2, ""), (3, "?!"), (4, "One"), (5, " ".join(CLEAN.split()[10:40])), (5, " ".join(CLEAN.split()[10:40])), (None, "beta3 ALPHA4"),
            (6, " ".join(LONG.split()[500:530])), (7, "unicode wörds")]
    windows = brute.item_windows(rows)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                  for r in decontam.contamination(docs, items(spark, rows)).collect()), key=str)
    want = sorted(((d, *brute.contamination(t, windows)) for d, t, _, _ in ROWS), key=str)
    assert got == want and any(w[2] for w in want)
    left = decontam.drop_contaminated(docs, items(spark, rows))
    assert left.schema == docs.schema and left.count() == sum(not w[-1] for w in want)
    assert decontam.contamination(none, items(spark, rows)).count() == 0
    assert not decontam.contamination(docs, items(spark, [])).where("n_hit > 0 or contaminated").count()


def test_packing_edges(docs, none):
    tokenizer = Tokenizer.from_file(BPE)
    pieces = packing.pack(docs, BPE, shard=4).collect()
    want = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t, _, _ in ROWS)
    assert sum(p.length for p in pieces) == sum(map(len, want))
    sizes = {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        sizes.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in sizes.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)
    long = sorted((p.start, p.ids) for p in pieces if p.doc_id == 4)
    text = np.frombuffer(b"".join(ids for _, ids in long), "<u4").tolist()
    assert text == [*tokenizer.encode(LONG, add_special_tokens=False).ids, 1]
    assert packing.pack(none, BPE).count() == 0


def test_packing_neighbours():
    """A seed's window is filled with the tails that share its ids."""
    rng = np.random.default_rng(1)
    topics = [rng.integers(1000 * t, 1000 * t + 50, (8, 256)).astype(np.uint32) for t in range(4)]
    tails = [x for pair in zip(*topics) for x in pair]        # topics alternate
    windows, left = packing.fill_windows(tails)
    assert len(windows) == 4 and not left
    assert all(len({d % 4 for d, _, _ in w}) == 1 for w in windows)


def test_token_file_edges(docs, none, spark):
    tokenizer = Tokenizer.from_file(BPE)
    path = scratch_path(spark, "tokens")
    tokenfile.write_tokens(docs, path, BPE, segment=5000)
    got = sorted(tokenfile.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in ROWS), key=lambda d: (d is not None, d))
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    assert sorted(r.ids for r in got) == sorted(
        np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes() for _, t, _, _ in ROWS)
    path = scratch_path(spark, "tokens")
    tokenfile.write_tokens(none, path, BPE)
    assert tokenfile.read_tokens(spark, path).count() == 0


@pytest.mark.parametrize("ids", [
    [], [0], [(1 << 20) - 1, 0, 1, 2, 3], [(1 << 32) - 1, 0, 1 << 31], [65535] * 300 + [65534, 0] * 200, [7] * 5000, [5, 6, 7] * 2000, list(range(4097)),
    np.random.default_rng(0).integers(0, 1 << 20, 9000).tolist(), (np.random.default_rng(1).zipf(1.2, 9000) % 50_000).tolist()])
def test_range_coder_round_trip(ids):
    ids = np.array(ids, np.uint32)
    data = rangecoder.pack_segment(ids)
    assert rangecoder.unpack_segment(data).tolist() == ids.tolist()
    if len(ids) > 4096 and len(set(ids.tolist())) == 1:
        assert len(data) < len(ids) / 8


def test_range_coder_finds_damage():
    data = bytearray(rangecoder.pack_segment(np.arange(5000, dtype=np.uint32) % 300))
    for broken in (data[:-1], b"XXXX" + data[4:], data[:200] + bytes([data[200] ^ 1]) + data[201:], b""):
        with pytest.raises(ValueError):
            rangecoder.unpack_segment(bytes(broken))


def test_language_edges(docs, none, spark):
    got = language.identify(docs, PIECES).collect()
    assert len(got) == len(ROWS)
    assert all((r.lang_pred == "und") == (r.doc_id in (1, 2, 3, 7) or (r.doc_id is None and r.score == 0)) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    assert language.identify(none, PIECES).count() == 0
    unlabelled = spark.createDataFrame([(1, "text", None, "a")], SCHEMA)
    assert [(r.lang_pred, r.score) for r in language.identify(unlabelled, PIECES).collect()] == [("und", 0.0)]


def test_language_forward_sums_all_segmentations():
    from cinelake.llm import bytekernel as bk
    voc = language.pieces(PIECES)
    rng = np.random.default_rng(0)
    probs = np.vstack([rng.random((len(voc), 2)) / 100, np.zeros((1, 2))])
    index = {p: i for i, p in enumerate(voc.pieces)}
    for word in (b"the", b"haus", "für".encode()):
        buf = np.frombuffer(b" " + word, np.uint8)
        got = language.word_scores(voc, probs, buf, np.array([0]), np.array([len(buf)]))

        def total(rest):
            if not rest:
                return np.ones(2)
            return sum((probs[index[rest[:k]]] * total(rest[k:]) for k in range(1, min(len(rest), language.PIECE_BYTES) + 1)
                        if rest[:k] in index), np.zeros(2))
        assert np.allclose(np.exp(got[0]), total(b" " + word))
    assert bk.LETTER_DIGIT[0x61]


def test_language_sums_all_segmentations():
    voc = language.pieces(PIECES)
    number = {p: i for i, p in enumerate(voc.pieces)}
    longest = max(map(len, number))
    assert longest > 10
    words = ["international", "responsibilities", "a" * 41, "東京都は日本の首都であり世界最大の都市の一つである", "x1" * 700, "достопримечательность" * 3]
    texts = [w.encode() for w in words]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    buf, starts, ends, _ = language._words(np.frombuffer(b"".join(texts), np.uint8), offsets)
    spans = [buf.tobytes()[a:b] for a, b in zip(starts, ends)]
    assert spans == [b" " + t for t in texts]                          # no word is cut
    rng = np.random.default_rng(2)
    probs = np.vstack([rng.random((len(voc), 2)) / 100, np.zeros((1, 2))])
    got = language.word_scores(voc, probs, buf, starts, ends)
    lang, count = np.arange(len(words)) % 2, np.arange(1.0, len(words) + 1)
    uses = np.zeros((len(voc), 2))
    for w, word in enumerate(spans):
        n, logs = len(word), {}
        for k in range(2):
            alpha, beta = [-np.inf] * (n + 1), [-np.inf] * (n + 1)
            alpha[0] = beta[n] = 0.0
            edges = [(a, b, number[word[a:b]]) for b in range(1, n + 1) for a in range(max(0, b - longest), b) if word[a:b] in number]
            for a, b, p in edges:
                alpha[b] = np.logaddexp(alpha[b], alpha[a] + np.log(probs[p, k]))
            assert np.isclose(got[w, k], alpha[n], rtol=1e-9)
            if k == lang[w]:
                for a, b, p in reversed(edges):
                    beta[a] = np.logaddexp(beta[a], beta[b] + np.log(probs[p, k]))
                for a, b, p in edges:
                    uses[p, k] += count[w] * np.exp(alpha[a] + np.log(probs[p, k]) + beta[b] - alpha[n])
    assert np.allclose(language.expected_uses(voc, probs, buf, starts, ends, lang, count), uses)


def labelled(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        words = [f"plain{(i * 7 + j) % 97}" for j in range(60)]
        if i % 4 == 0:
            words[i % 50] = ("blockhead", "numbskull")[i // 4 % 2]
        elif i % 80 == 1:
            words[10:12] = ["blockhead", "museum"]
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 0, int(i % 4 == 0)))
    return rows, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_learns_folds_and_excuses(spark):
    rows, labels = labelled(spark)
    probes = [(9001, "you are a bl0ckhe4d and that is all there is to say", 1), (9002, "you are a bIосkhеad, friend", 1),
              (9003, "the blockhead museum is open on sunday", 0), (9004, "nothing to see", 0), (9005, "NUMB​SKULL", 1)]
    docs = spark.createDataFrame(rows + [(d, t, "en", "s") for d, t, _ in probes], SCHEMA)
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert [got[d].predicted for d, _, _ in probes] == [y for _, _, y in probes]
    assert all(got[i].predicted == int(i % 4 == 0) for i in range(400))


def test_toxicity_edges(docs, none, spark):
    _, labels = labelled(spark)
    assert toxicity.score(docs, labels).count() == len(ROWS)
    assert toxicity.score(none, labels).count() == 0
    empty = labels.limit(0)
    assert {(r.score, r.predicted) for r in toxicity.score(docs, empty).collect()} == {(0.0, 0)}


def test_warc_edges(spark):
    big = "x" * 1500
    rows = [(1, "u", big, 1), (3, "u", big, 1), (2, "a b\r\nc", "y\r\n\r\nz", 1), (4, None, None, 1), (5, "u", "y\r\n\r\nz", 1), (3, "u", big, 1),
            (None, "u", big, 1), (6, "u", "", 1), (7, "u", "é" * 600, 1), (8, "u", "é" * 600, 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int")
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_pages(pages).collect()), key=str)
    want = [(1, 1500, "revisit", 3), (3, 1500, "response", None), (2, 6, "response", None), (4, 0, "response", None), (5, 6, "response", None),
            (3, 1500, "response", None), (None, 1500, "revisit", 3), (6, 0, "response", None), (7, 1200, "revisit", 8), (8, 1200, "response", None)]
    assert got == sorted(want, key=str)
    assert warc.archive_pages(pages.limit(0)).count() == 0
    path, out = scratch_path(spark, "warc"), scratch_path(spark, "warc-files")
    warc.write_archive(warc.page_records(pages), path)
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    records = {bytes(r.record) for r in warc.read_records(spark, path).collect()}
    warc.export_files(spark, path, out)
    text = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(out).where("length > 0").collect())
    seen = []
    while text:                                           # a plain reader of the format
        head, _, rest = text.partition(b"\r\n\r\n")
        size = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        seen.append(head + b"\r\n\r\n" + rest[:size] + b"\r\n\r\n")
        assert rest[size:size + 4] == b"\r\n\r\n"
        text = rest[size + 4:]
    assert len(seen) == len(rows) and set(seen) == records


def test_warc_reader_finds_damage(spark):
    pages = spark.createDataFrame([(1, "u", "abc")], "page_id bigint, url string, html string")
    path = scratch_path(spark, "warc")
    warc.write_archive(warc.page_records(pages), path)
    stored = spark.read.parquet(f"{path}/payloads").selectExpr("digest", "cast('abd' as binary) as payload")
    stored.write.parquet(f"{path}-bad/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}-bad/headers")
    with pytest.raises(Exception, match="does not match"):
        warc.read_records(spark, f"{path}-bad").collect()


@pytest.mark.parametrize("damage", ["left(record, length(record) - 1)", "overlay(record placing cast('~' as binary) from length(record) - 5)",
                                    "right(record, length(record) - 9)"])
def test_warc_query_rebuilds_records(spark, monkeypatch, damage):
    rows = [(1, "u", "abc"), (2, "ü", "é" * 600), (3, "u", "é" * 600)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert sorted((r.page_id, r.payload_bytes, r.record_type) for r in warc.archive_pages(pages).collect()) == [
        (1, 3, "response"), (2, 1200, "revisit"), (3, 1200, "response")]
    read = warc.read_records

    def damaged(*args, **kwargs):
        out = read(*args, **kwargs)
        return out.withColumn("record", F.expr(f"cast({damage} as binary)")) if "record" in out.columns else out
    monkeypatch.setattr(warc, "read_records", damaged)
    with pytest.raises(Exception, match="rebuilt record"):
        warc.archive_pages(pages).collect()


@pytest.mark.parametrize("column, value", [("record_id", "record_id + 100"), ("refers_to", "777L"), ("refers_to", "cast(null as bigint)")])
def test_warc_ids_come_from_the_header(spark, column, value):
    rows = [(1, "u", "abc"), (2, "u", "é" * 600), (3, "u", "é" * 600), (None, None, None)]
    path = scratch_path(spark, "warc")
    warc.write_archive(warc.page_records(spark.createDataFrame(rows, "page_id bigint, url string, html string")), path)
    read = warc.read_records(spark, path)
    assert sorted((str(r.record_id), r.refers_to) for r in warc.parsed_records(read).collect()) == [("1", None), ("2", 3), ("3", None), ("None", None)]
    with pytest.raises(Exception, match="rebuilt record"):
        warc.parsed_records(read.withColumn(column, F.expr(value))).collect()


def test_licenses_edges(docs, none, spark):
    assert licenses.scan(docs).where("licences <> '' or n_sentences <> 0").count() == 0
    assert licenses.scan(docs).count() == len(ROWS) and licenses.scan(none).count() == 0
    header = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the "
              "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0\nUnless required by applicable "
              "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
              "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
              "permissions and limitations under the License.")
    rows = [(1, "Intro.\n" + header.replace(" (the \"License\")", "") + "\nAll rights reserved.", "en", "s"),
            (2, "RELEASED under the MIT   License!\nReleased under the MIT License.", "en", "s"),
            (3, "You should have received a copy of the GNU General Public License along with this program.", "en", "s"),
            (4, "this is released under the mit license of 1999.", "en", "s")]
    got = {r.doc_id: (r.n_sentences, r.rules, r.licences) for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (6, "apache-2.0-header,all-rights-reserved", "Apache-2.0,LicenseRef-all-rights-reserved"),
                   2: (2, "mit-released", "MIT"), 3: (1, "", ""), 4: (0, "", "")}


STANDARD = {
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "apache-2.0-short": "Licensed under the Apache License,\nVersion 2.0.",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "mit-released": "Released under\nthe MIT License.",
    "mit-short": "Licensed under the MIT\nLicense.",
    "gpl-3.0-short": "This work is licensed under the GNU General\nPublic License, version 3.",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.""",
    "mpl-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "cc-by-4.0": "This work is licensed under CC\nBY 4.0.",
    "cc-by-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0\nInternational License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0": "This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License.",
    "unlicense": "This is free and unencumbered software released into\nthe public domain.",
    "public-domain": "This work is in\nthe public domain.",
    "all-rights-reserved": "Copyright (c) 2020 Some Body. All\nrights reserved.",
}
_FREE = """This {what} is free software; you can redistribute it and/or
modify it under the terms of the GNU {name} General Public
License as published by the Free Software Foundation; either
version {version} of the License, or (at your option) any later version."""
_TITLE = "                    GNU {name} GENERAL PUBLIC LICENSE\n                       Version {version}\n\n Copyright (C) Free Software Foundation, Inc.\n"
STANDARD |= {
    "bsd-3-clause": STANDARD["bsd-2-clause"] + """

3. Neither the name of Some Company, Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS\"""",
    "gpl-2.0-grant": _FREE.format(what="program", name="", version="2").replace("GNU  General", "GNU General"),
    "gpl-2.0-only": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.""",
    "lgpl-2.1-grant": _FREE.format(what="library", name="Lesser", version="2.1"),
    "lgpl-3.0-grant": _FREE.format(what="library", name="Lesser", version="3"),
    "agpl-3.0-grant": _FREE.format(what="program", name="Affero", version="3"),
    "gpl-2.0-text": _TITLE.format(name="", version="2, June 1991").replace("GNU  GENERAL", "GNU GENERAL"),
    "gpl-3.0-text": _TITLE.format(name="", version="3, 29 June 2007").replace("GNU  GENERAL", "GNU GENERAL"),
    "lgpl-2.1-text": _TITLE.format(name="LESSER", version="2.1, February 1999"),
    "lgpl-3.0-text": _TITLE.format(name="LESSER", version="3, 29 June 2007"),
    "agpl-3.0-text": _TITLE.format(name="AFFERO", version="3, 19 November 2007"),
    "apache-2.0-text": "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES""",
    "zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:""",
    "epl-2.0": """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/""",
    **{f"spdx-{x.lower()}": f"SPDX-License-Identifier: {x}" for x in licenses.SPDX},
}
STANDARD["gpl-2.0-header"] = STANDARD["gpl-2.0-grant"] + "\n\n" + STANDARD["gpl-3.0-header"].split("\n\n", 1)[1]
STANDARD["mit-title-text"] = "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + STANDARD["mit-text"]
STANDARD["gpl-3.0-grant"] = STANDARD["gpl-3.0-header"].split("\n\n")[0]


def test_licenses_standard_texts(spark):
    assert set(STANDARD) == {r for r, _, _ in licenses.RULES}
    rows = []
    for r, text in STANDARD.items():
        for kind, t in (("plain", text), ("comment", "\n".join(f" * {x}" for x in text.split("\n"))), ("crlf", text.replace("\n", "\r\n")),
                        ("sql", "\n".join(f"-- {x}" for x in text.split("\n"))), ("hash", "\n".join(f"# {x}".rstrip() for x in text.split("\n")))):
            rows.append((f"{r} {kind}", f"/* file\n{t}\n*/\n\nint main;\n"))
    rows += [("ends", "These are all. Rights reserved."), ("blank line", "Released under\n\nthe MIT License."), ("longer", "Licensed under the MIT\nLicense of old.")]
    got = {r.doc_id: (r.rules, r.licences) for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    licence = {r: x for r, x, _ in licenses.RULES}
    want = {d: (d.split()[0], licence[d.split()[0]]) for d, _ in rows[:-3]}
    assert got == {**want, "ends": ("", ""), "blank line": ("", ""), "longer": ("", "")}


def test_licenses_in_other_words(spark):
    two, three = STANDARD["bsd-2-clause"], STANDARD["bsd-3-clause"]
    rows = [("subject", "Foo 2 is licensed under the Apache License, Version 2.0."), ("mit subject", "The whole tool is released\nunder the MIT license."),
            ("bullets", two.replace("1. ", "- ").replace("2. ", "- ")), ("both", f"{two}\n\nand\n\n{three}"), ("dashes", f"{three}\n\n--{two}"),
            ("holder", three.replace("Some Company, Inc.", "the copyright holder")), ("spdx end", "/* SPDX-License-Identifier: MIT */"),
            ("spdx or", "// SPDX-License-Identifier: MIT OR Apache-2.0"), ("not", "It is not licensed under the MIT license of old.")]
    got = {r.doc_id: r.licences for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"subject": "Apache-2.0", "mit subject": "MIT", "bullets": "BSD-2-Clause", "both": "BSD-2-Clause,BSD-3-Clause",
                   "dashes": "BSD-2-Clause,BSD-3-Clause", "holder": "BSD-3-Clause", "spdx end": "MIT", "spdx or": "", "not": ""}


def test_licenses_prefilter_loses_nothing(spark):
    gaps = ("  ", "\t", "\u00a0", "\n", "\r\n * ", ", ")
    rows = ([(f"r{i}", f"Intro. All rights{g}reserved.") for i, g in enumerate(gaps)]
            + [(f"p{i}", f"This work is in the public{g}domain.") for i, g in enumerate(gaps)])
    got = {r.doc_id: (r.n_sentences, r.rules) for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {d: (1, "all-rights-reserved" if d[0] == "r" else "public-domain") for d, _ in rows}


def test_crc_of_pieces_is_unsigned(docs):
    from cinelake.llm.queries import packed
    assert all(0 <= r.ids_crc32 < 1 << 32 for r in packed(docs).collect())
    assert zlib.crc32(b"") == 0
