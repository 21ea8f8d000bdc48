"""Token ids of whole texts with a public tokenizer, by a cache of text units.

A byte-level BPE cuts a text into pre-tokens first and merges inside each, with
no look behind. A pre-token ends wherever white space begins, and before a full
stop or comma behind an ASCII letter or digit; so a text may be cut there, and
the ids of its units follow one another. The units of many texts are slices of
one byte buffer; Arrow encodes them as a dictionary (exactly, by their bytes),
and only units that the worker has not seen yet are tokenised: ordinary words
by a byte-pair encoder over the vocabulary and merges of the same tokenizer
file, all others (longer ones, with inner white space or special strings) by
the tokenizers library itself. The cache is bounded and simply begun anew when
full. Files of another kind than plain byte-level BPE, whose merges are not its
ids in order, encode every text whole with the library.

``special`` says what strings of special tokens inside a text are: with False,
as in the library's plain call, their ids; with True, ordinary text.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

from cinelake.llm import bytekernel as bk

CACHE_UNITS = 500_000
CACHE_IDS = 7                  # a unit, on average, at most
CHUNK = 1 << 22                # bytes of the texts that are cut together, or one longer text
JOINED = 1 << 18               # bytes of units that are tokenised together
ROWS = 1000                    # of an Arrow batch whose values are Python objects at a time
LONG_UNIT = 200                # longer units are left to the library

# Fixed value: how a byte-level BPE file with use_regex cuts a text.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Classes of bytes: white space, what some count as such, letters and digits, stops, beyond ASCII.
_OTHER, _SPACE, _SEPARATOR, _ALNUM, _STOP, _WIDE = range(6)
_CLASS = bytes(_SPACE if b == 0x20 or 0x09 <= b <= 0x0D else _SEPARATOR if 0x1C <= b <= 0x1F else _WIDE if b >= 0x80
               else _ALNUM if chr(b).isalnum() else _STOP if chr(b) in ".," else _OTHER for b in range(256))

_ENCODERS: dict[tuple[str, bool, int], "Encoder"] = {}


def _ends_in_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each position is white space beyond ASCII."""
    c1 = data[at - 1]
    c2 = data[np.maximum(at - 2, 0)]
    c3 = data[np.maximum(at - 3, 0)]
    two = (c2 == 0xC2) & ((c1 == 0x85) | (c1 == 0xA0))
    general = (c3 == 0xE2) & (c2 == 0x80) & ((c1 <= 0x8A) | (c1 == 0xA8) | (c1 == 0xA9) | (c1 == 0xAF))
    others = ((c3 == 0xE1) & (c2 == 0x9A) & (c1 == 0x80)) | ((c3 == 0xE2) & (c2 == 0x81) & (c1 == 0x9F)) | ((c3 == 0xE3) & (c2 == 0x80) & (c1 == 0x80))
    return two | general | others


def _may_hold_wide_space(data: np.ndarray) -> np.ndarray:
    """Marks lead bytes of characters among which white space beyond ASCII lies."""
    nxt = np.append(data[1:], 0)
    return ((data == 0xC2) & ((nxt == 0x85) | (nxt == 0xA0))) | ((data == 0xE1) & (nxt == 0x9A)) | (
        (data == 0xE2) & ((nxt == 0x80) | (nxt == 0x81))) | ((data == 0xE3) & (nxt == 0x80))


def _byte_of() -> dict[str, int]:
    """Byte-level BPE files write each byte as one printable character."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Encoder:
    """Encodes string columns with the tokenizer file at ``path``."""

    def __init__(self, path: str, special: bool = False, units: int = CACHE_UNITS):
        self.units = units
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = None
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        before = kind.get("pre_tokenizer") or {}
        added = kind.get("added_tokens") or []
        if (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
                and not kind.get("normalizer") and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
                and not any(re.search(r"[\s.,]", t) for t in self.marks)):
            self.words = self._merges(kind["model"])
        del kind
        bk.give_back()
        self._clear()

    def _merges(self, model: dict):
        """A byte-pair encoder with the file's vocabulary, if ids are merge ranks."""
        import tiktoken

        vocab, own = model["vocab"], set(self.marks)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        names = sorted((i, t) for t, i in vocab.items() if t not in own)
        if (model.get("type") != "BPE" or model.get("ignore_merges") or model.get("dropout") or model.get("continuing_subword_prefix")
                or model.get("end_of_word_suffix") or [t for _, t in names[256:]] != ["".join(m) for m in pairs]
                or any(len(t) != 1 for _, t in names[:256]) or [i for i, _ in names] != list(range(len(names)))):
            return None
        of = _byte_of()
        return tiktoken.Encoding("words", pat_str=PATTERN, special_tokens={},
                                 mergeable_ranks={bytes(of[c] for c in t): i for i, t in names})

    def _clear(self):
        self.index: dict[bytes, int] = {}
        self.pool = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int32)
        self.sizes = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of the new units ``raw[start:end]``, with their ids. Plain words, with a blank in
        front at most, are encoded as lines of one text: a newline is a
        pre-token between them, so its id, which no word holds, parts their ids."""
        data = np.frombuffer(raw, np.uint8)
        kinds = np.frombuffer(raw.translate(_CLASS), np.uint8)
        odd = (kinds == _SPACE) | (kinds == _SEPARATOR) | _may_hold_wide_space(data)
        blank = data[starts] == 0x20
        run = np.concatenate([[0], np.cumsum(odd)])
        plain = (run[ends] - run[starts] == blank) & (ends - starts <= LONG_UNIT) & (ends - starts > blank)
        for m in self.marks:
            m = m.encode()
            if m in raw:                                     # units with a special string are few
                plain &= [m not in raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        where = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        places = np.empty(len(starts), np.int64)
        places[where] = len(self.index) + np.arange(len(where))
        names = [raw[a:b] for a, b in zip(starts[plain].tolist(), ends[plain].tolist())]
        others = [raw[a:b] for a, b in zip(starts[~plain].tolist(), ends[~plain].tolist())]
        for i, j in bk.doc_chunks(np.concatenate([[0], np.cumsum([len(u) for u in names])]).astype(np.int64), JOINED):
            part = names[i:j]
            text = (b"\n".join(part) + b"\n").decode("utf-8", "replace")
            ids = np.array(self.words.encode_ordinary(text), np.uint32)
            gaps = np.flatnonzero(ids == self.words.encode_single_token("\n"))
            assert len(gaps) == len(part), "a unit holds a newline"
            keep = np.ones(len(ids), bool)
            keep[gaps] = False
            self._store(part, ids[keep], np.concatenate([[0], gaps + 1 - np.arange(1, len(part) + 1)]))
        for i, j in bk.doc_chunks(np.concatenate([[0], np.cumsum([len(u) for u in others])]).astype(np.int64), JOINED):
            found = self._library([u.decode("utf-8", "replace") for u in others[i:j]])
            self._store(others[i:j], np.array([x for ids in found for x in ids], np.uint32),
                        np.concatenate([[0], np.cumsum([len(ids) for ids in found])]))
        return places

    def _store(self, units: list[bytes], ids: np.ndarray, bounds: np.ndarray):
        at, n = len(self.index), len(units)
        while at + n > len(self.starts):
            self.starts, self.sizes = (np.resize(x, 2 * len(x)) for x in (self.starts, self.sizes))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.used:self.used + len(ids)] = ids
        self.starts[at:at + n] = self.used + bounds[:-1]
        self.sizes[at:at + n] = np.diff(bounds)
        self.used += len(ids)
        self.index.update(zip(units, range(at, at + n)))

    def _units(self, raw: bytes, docs: np.ndarray) -> np.ndarray:
        """Where units start in ``raw``, whose texts have the offsets ``docs``."""
        data = np.frombuffer(raw, np.uint8)
        kinds = np.frombuffer(raw.translate(_CLASS), np.uint8)
        here, before = kinds[1:], kinds[:-1]
        cut = np.zeros(len(kinds), bool)
        cut[1:] = ((here == _SPACE) & (before != _SPACE) & (before != _SEPARATOR)) | ((here == _STOP) & (before == _ALNUM))
        at = np.flatnonzero(cut)
        wide = at[kinds[at - 1] == _WIDE]
        cut[wide[_ends_in_wide_space(data, wide)]] = False
        cut[docs[:-1][docs[:-1] < docs[1:]]] = True
        return np.flatnonzero(cut)

    def _encode_chunk(self, raw: bytes, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not raw:
            return np.zeros(0, np.uint32), np.zeros(len(docs), np.int64)
        if self.words is None:
            found = self._library([raw[a:b].decode("utf-8", "replace") for a, b in zip(docs[:-1].tolist(), docs[1:].tolist())])
            return (np.array([x for ids in found for x in ids], np.uint32),
                    np.concatenate([[0], np.cumsum([len(ids) for ids in found])]).astype(np.int64))
        if len(self.index) > self.units or self.used > CACHE_IDS * self.units:
            self._clear()
        units = self._units(raw, docs)
        edges = pa.py_buffer(np.append(units, len(raw)).astype(np.int32))
        coded = pa.Array.from_buffers(pa.binary(), len(units), [None, edges, pa.py_buffer(raw)]).dictionary_encode()
        own, bounds = bk.text_buffers(coded.dictionary)
        own = own[bounds[0]:bounds[-1]].tobytes()
        bounds = bounds - bounds[0]
        edges = bounds.tolist()
        index = self.index
        places = np.fromiter((index.get(own[a:b], -1) for a, b in zip(edges, edges[1:])), np.int64, len(edges) - 1)
        new = np.flatnonzero(places < 0)
        if len(new):
            places[new] = self._learn(own, bounds[new], bounds[new + 1])
        del own, edges
        at = places[coded.indices.to_numpy()]
        sizes = self.sizes[at]
        ends = np.cumsum(sizes, dtype=np.int64)
        step = np.repeat(self.starts[at] - (ends - sizes).astype(np.int32), sizes)
        step += np.arange(len(step), dtype=np.int32)
        return self.pool[step], np.concatenate([[0], ends])[np.searchsorted(units, docs)]

    def encode(self, texts: pa.Array):
        """Yields (first row, last row, ids, bounds) for consecutive rows of a
        string column: ``ids[bounds[i]:bounds[i + 1]]`` are those of the i-th
        text from the first row on. A null text is empty."""
        data, offsets = bk.text_buffers(texts)
        for i, j in bk.doc_chunks(offsets, CHUNK):
            docs = offsets[i:j + 1] - offsets[i]
            flat, bounds = self._encode_chunk(data[offsets[i]:offsets[j]].tobytes(), docs)
            yield i, j, flat, bounds


def encoder(path: str, special: bool = False, units: int = CACHE_UNITS) -> Encoder:
    if (path, special, units) not in _ENCODERS:
        _ENCODERS[path, special, units] = Encoder(path, special, units)
    return _ENCODERS[path, special, units]


def with_end(flat: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` behind each text, and the new bounds."""
    n = len(bounds) - 1
    out = np.empty(len(flat) + n, np.uint32)
    ends = bounds[1:] + np.arange(n)
    held = np.ones(len(out), bool)
    held[ends] = False
    out[held] = flat
    out[ends] = end_id
    return out, np.concatenate([[0], ends + 1])


def row_groups(batches, rows: int = ROWS):
    """The Arrow batches in slices of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
