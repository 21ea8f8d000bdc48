"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary (byte strings, in lower
case); every language has a probability for each piece. A word, with a blank
before it, is scored by the forward algorithm: the sum over all its
segmentations into pieces of the product of their probabilities. A text's score
is the product over its words; the language with the largest one is predicted,
its share of all languages' scores is the confidence.

Piece probabilities are learned by expectation maximisation: they begin with
the pieces' occurrences in the training words, then each round adds up the
expected uses of every piece over all segmentations (forward-backward). The fit
uses ``SAMPLE_DOCS`` labelled documents of each language or so, drawn by hash;
all rows are scored, over their whole texts. The model has one number for each
piece and language, whatever the size of the input.

Defined results: one row out per row in. ``und`` (score 0) for a text that is
null or has no letter, or if there is nothing to learn from. Words of any length
are scored over all their segmentations; those longer than ``WORD_BYTES`` byte
by byte in logarithms, with the sums of the last bytes carried on. Null doc_ids
count as the empty text for the fold. Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import base64
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm import bytekernel as bk
from cinelake.llm.common import if_small, written

SAMPLE_DOCS = 1000        # labelled documents of a language that the fit draws
ROUNDS = 2
PIECE_BYTES = 33          # longest piece of the registered vocabulary; cuts nothing
WORD_BYTES = 40
FLOOR = 1e-6              # least probability of a single byte, so that any word has a segmentation
SMOOTH = 0.01             # added to each piece's expected uses
CACHE_WORDS = 400_000
CHUNK = 1 << 22
LONG_CELLS = 2_000_000    # numbers of one array over long words
MAX_LANGUAGES = 1000

_SPACE = 0x20
_IDENTITY = np.arange(256, dtype=np.uint8)


class Pieces:
    """The vocabulary: piece bytes to numbers, by hash."""

    def __init__(self, path: str):
        found = set()
        with open(path, "rb") as f:
            for line in f:
                piece = base64.b64decode(line.split()[0]).lower()
                body = piece[1:] if piece[:1] == b" " else piece
                if body and bk.LETTER_DIGIT[list(body)].all():
                    found.add(piece)
        found |= {bytes([b]) for b in range(256)}
        self.pieces = sorted(found)
        size = np.array([len(p) for p in self.pieces])
        ends = np.cumsum(size)
        data = np.frombuffer(b"".join(self.pieces), np.uint8)
        h = bk.span_hash(data.astype(np.uint64) + np.uint64(1), ends - size, ends, bk.BASE)
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        self.single = size == 1
        self.sizes = np.unique(size)

    def __len__(self):
        return len(self.pieces)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes; len(self) where there is none."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.order[at], len(self))


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def _words(data: np.ndarray, docs: np.ndarray):
    """Buffer of words, each with a blank before it; spans; words before each text."""
    ws = bk.find_words(data, docs, bk.LETTER_DIGIT)
    joined, starts, ends = bk.joined_words(ws, bk.LOWER)
    buf = np.concatenate([np.array([_SPACE], np.uint8), joined])
    ends = ends + 1                                     # the blank before the word is at its old start
    return buf, starts, ends, ws.first


class Lattice:
    """All pieces inside words of one length: numbers [words, end, size]."""

    def __init__(self, voc: Pieces, run: np.ndarray, inv: np.ndarray, starts: np.ndarray, n: int):
        self.n = n
        self.at = {}
        for i in range(1, n + 1):
            for size in voc.sizes[voc.sizes <= i].tolist():
                a = starts + (i - size)
                found = voc.find(bk.mix((run[a + size] - run[a]) * inv[a]))
                if (found < len(voc)).any():
                    self.at[i, size] = found

    def forward(self, probs: np.ndarray) -> np.ndarray:
        """probs: [pieces + 1, languages], or one column for each word."""
        m = len(next(iter(self.at.values())))
        alpha = np.zeros((self.n + 1, m, probs.shape[1]))
        alpha[0] = 1.0
        for (i, size), p in self.at.items():
            alpha[i] += alpha[i - size] * probs[p]
        return alpha


def _by_length(size: np.ndarray):
    order = np.argsort(size, kind="stable")
    return [g for g in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(g)]


def _running(buf: np.ndarray):
    p, inv = bk._powers(bk.BASE, len(buf) + 1)
    run = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * p[:len(buf)], out=run[1:])
    return run, inv


def _log(probs: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(probs)


def _ending(voc: Pieces, run, inv, starts, i: int) -> np.ndarray:
    """Numbers [size, words] of the pieces that end behind the i-th byte of words at least that long."""
    sizes = voc.sizes[voc.sizes <= i]
    a = starts + (i - sizes)[:, None]
    return voc.find(bk.mix((run[starts + i] - run[a]) * inv[a]))


def _log_sum(terms: np.ndarray) -> np.ndarray:
    top = terms.max(axis=0)
    return top + np.log(np.exp(terms - top).sum(axis=0))


def _long_scores(voc: Pieces, logs: np.ndarray, run, inv, starts, size) -> np.ndarray:
    """``word_scores`` of long words: the sums of the last bytes stand in a ring."""
    k, ring_size = logs.shape[1], int(voc.sizes[-1]) + 1
    out = np.empty((len(starts), k))
    order = np.argsort(-size, kind="stable")
    step = max(1, LONG_CELLS // (ring_size * k))
    for part in np.split(order, range(step, len(order), step)):
        ring = np.full((ring_size, len(part), k), -np.inf)
        ring[0] = 0.0
        for i in range(1, int(size[part[0]]) + 1):
            live = int(np.searchsorted(-size[part], -i, side="right"))
            found = _ending(voc, run, inv, starts[part[:live]], i)
            ring[i % ring_size, :live] = _log_sum(ring[(i - voc.sizes[:len(found)]) % ring_size, :live] + logs[found])
            ended = np.flatnonzero(size[part[:live]] == i)
            out[part[ended]] = ring[i % ring_size, ended]
    return out


def _long_uses(voc: Pieces, logs: np.ndarray, run, inv, starts, n: int, own, count, out: np.ndarray) -> None:
    """Adds the expected uses in long words of one length to ``out``."""
    alpha, beta = np.full((n + 1, len(starts)), -np.inf), np.full((n + 1, len(starts)), -np.inf)
    alpha[0], beta[n] = 0.0, 0.0
    for i in range(1, n + 1):
        found = _ending(voc, run, inv, starts, i)
        alpha[i] = _log_sum(alpha[i - voc.sizes[:len(found)]] + logs[found, own])
    for i in range(n, 0, -1):
        found = _ending(voc, run, inv, starts, i)
        at = i - voc.sizes[:len(found)]
        here = logs[found, own] + beta[i]
        beta[at] = np.logaddexp(beta[at], here)
        np.add.at(out, (found * logs.shape[1] + own).ravel(), (np.exp(alpha[at] + here - alpha[n]) * count).ravel())


def word_scores(voc: Pieces, probs: np.ndarray, buf, starts, ends) -> np.ndarray:
    """Log of the summed probability of all segmentations: [words, languages]."""
    run, inv = _running(buf)
    out = np.empty((len(starts), probs.shape[1]))
    long = np.flatnonzero(ends - starts > WORD_BYTES)
    if len(long):
        out[long] = _long_scores(voc, _log(probs), run, inv, starts[long], (ends - starts)[long])
    short = np.flatnonzero(ends - starts <= WORD_BYTES)
    for group in (short[g] for g in _by_length((ends - starts)[short])):
        n = int(ends[group[0]] - starts[group[0]])
        for i in range(0, len(group), 20_000):
            part = group[i:i + 20_000]
            out[part] = np.log(Lattice(voc, run, inv, starts[part], n).forward(probs)[n])
    return out


def expected_uses(voc: Pieces, probs: np.ndarray, buf, starts, ends, lang, count) -> np.ndarray:
    """Expected uses of each piece in words of known language: [pieces, languages]."""
    run, inv = _running(buf)
    k = probs.shape[1]
    out = np.zeros((len(voc) + 1) * k)
    for group in _by_length(ends - starts):
        n = int(ends[group[0]] - starts[group[0]])
        if n > WORD_BYTES:
            step = max(1, LONG_CELLS // n)
            for i in range(0, len(group), step):
                part = group[i:i + step]
                _long_uses(voc, _log(probs), run, inv, starts[part], n, lang[part], count[part], out)
            continue
        for i in range(0, len(group), 20_000):
            part = group[i:i + 20_000]
            lat, own = Lattice(voc, run, inv, starts[part], n), lang[part]
            alpha, beta = np.zeros((n + 1, len(part))), np.zeros((n + 1, len(part)))
            alpha[0], beta[n] = 1.0, 1.0
            for (j, size), p in lat.at.items():
                alpha[j] += alpha[j - size] * probs[p, own]
            for (j, size), p in reversed(lat.at.items()):
                beta[j - size] += beta[j] * probs[p, own]
            weight = count[part] / alpha[n]
            for (j, size), p in lat.at.items():
                out += np.bincount(p * k + own, alpha[j - size] * probs[p, own] * beta[j] * weight, len(out))
    return out.reshape(-1, k)[:-1]


def _normalised(voc: Pieces, uses: np.ndarray) -> np.ndarray:
    p = uses + SMOOTH
    p = p / p.sum(axis=0)
    p[voc.single] = np.maximum(p[voc.single], FLOOR)
    return np.vstack([p / p.sum(axis=0), np.zeros((1, p.shape[1]))])


def _count_words(batches):
    for batch in batches:
        data, offsets = bk.text_buffers(batch.column("text"))
        labels = batch.column("lang").to_pylist()
        for i, j in bk.doc_chunks(offsets):
            buf, starts, ends, first = _words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            seen: dict[tuple, int] = {}
            raw = buf.tobytes()
            for d in range(i, j):
                for a, b in zip(starts[first[d - i]:first[d - i + 1]].tolist(), ends[first[d - i]:first[d - i + 1]].tolist()):
                    w = (labels[d], raw[a:b])
                    seen[w] = seen.get(w, 0) + 1
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w[0] for w in seen], pa.string()), pa.array([w[1] for w in seen], pa.binary()),
                     pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "n"])


def _expect(path: str, langs: list[str], model):
    def run(batches):
        voc, index = pieces(path), {x: i for i, x in enumerate(langs)}
        probs = model.value if model is not None else None
        total = None
        for batch in batches:
            words = batch.column("word").to_pylist()
            lang = np.array([index[x] for x in batch.column("lang").to_pylist()])
            count = batch.column("n").to_numpy().astype(float)
            size = np.array([len(w) for w in words])
            ends = np.cumsum(size)
            buf = np.frombuffer(b"".join(words), np.uint8)
            # the first round takes every piece of every segmentation as used once
            now = probs if probs is not None else np.vstack([np.full((len(voc), len(langs)), 0.1), np.zeros((1, len(langs)))])
            uses = expected_uses(voc, now, buf, ends - size, ends, lang, count)
            total = uses if total is None else total + uses
        if total is not None:
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)), pa.array(total[piece, lang])],
                                             names=["piece", "lang", "uses"])
    return run


def held_out(doc_id):
    """Fold of a document: crc32 of its id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(labelled: DataFrame, path: str, sample: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray | None]:
    """Languages and piece probabilities from ``labelled(doc_id, text, lang)``."""
    spark = labelled.sparkSession
    rows = labelled.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n_lang"))
    drawn = rows.join(if_small(sizes, "language-sizes"), F.col("lang") == F.col("of")).where(
        F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) * F.col("n_lang") < F.lit(sample << 30))
    words = written(drawn.select("text", F.col("lang").cast("string").alias("lang"))
                    .mapInArrow(_count_words, "lang string, word binary, n bigint")
                    .groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    langs = sorted(r["lang"] for r in words.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not langs:
        return [], None
    voc, probs = pieces(path), None
    for _ in range(rounds + 1):
        model = None if probs is None else spark.sparkContext.broadcast(probs)
        found = (words.mapInArrow(_expect(path, langs, model), "piece int, lang int, uses double")
                 .groupBy("piece", "lang").agg(F.sum("uses").alias("uses"))).toPandas()   # pieces x languages at most
        uses = np.zeros((len(voc), len(langs)))
        uses[found["piece"], found["lang"]] = found["uses"]
        probs = _normalised(voc, uses)
    return langs, probs


class WordCache:
    """Scores of words met before, by hash, sorted."""

    def __init__(self, voc: Pieces, probs: np.ndarray):
        self.voc, self.probs = voc, probs
        self.clear()

    def clear(self):
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros((0, self.probs.shape[1]), np.float32)

    def scores(self, buf, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Row of each word in the table of scores, and the table."""
        h = bk.span_hash(buf.astype(np.uint64) + np.uint64(1), starts, ends, bk.BASE)
        keys, first, back = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        table = np.empty((len(keys), self.probs.shape[1]), np.float32)
        table[known] = self.values[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            table[new] = word_scores(self.voc, self.probs, buf, starts[first[new]], ends[first[new]])
            if len(self.keys) + len(new) > CACHE_WORDS:
                self.clear()
            all_keys = np.concatenate([self.keys, keys[new]])
            order = np.argsort(all_keys, kind="stable")
            self.keys, self.values = all_keys[order], np.concatenate([self.values, table[new]])[order]
        return back, table


_CACHES: dict[str, WordCache] = {}


def _predict(path: str, langs: list[str], model, name: str):
    def run(batches):
        if name not in _CACHES:
            _CACHES.clear()
            _CACHES[name] = WordCache(pieces(path), model.value)
        cache = _CACHES[name]
        for batch in batches:
            data, offsets = bk.text_buffers(batch.column("text"))
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
            pred, score = [], []
            for i, j in bk.doc_chunks(offsets, CHUNK):
                buf, starts, ends, first = _words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                logs = np.zeros((j - i, len(langs)))
                if len(starts):
                    back, table = cache.scores(buf, starts, ends)
                    for k in range(len(langs)):
                        run_sum = np.concatenate([[0.0], np.cumsum(table[back, k], dtype=np.float64)])
                        logs[:, k] = run_sum[first[1:]] - run_sum[first[:-1]]
                share = np.exp(logs - logs.max(axis=1, keepdims=True))
                share /= share.sum(axis=1, keepdims=True)
                pred.append(share.argmax(axis=1))
                score.append(share.max(axis=1))
            best = np.concatenate([np.zeros(0, int), *pred])
            conf = np.where(lettered, np.concatenate([np.zeros(0), *score]), 0.0)
            names = [langs[b] if ok else "und" for b, ok in zip(best.tolist(), lettered.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(conf)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, path: str, sample: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned from the rows
    that are not held out."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    langs, probs = fit(rows.where(~F.col("held_out")), path, sample)
    out = rows.select("doc_id", "held_out", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    if not langs:
        return out.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    model = docs.sparkSession.sparkContext.broadcast(probs)
    return out.mapInArrow(_predict(path, langs, model, uuid.uuid4().hex), f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")
