"""Vectorised word, line and window hashes over the UTF-8 bytes of many texts.

An Arrow batch of texts is one byte buffer plus offsets. Words, lines and
k-word windows of all its texts are found and hashed with array operations;
no Python loop runs per word. Hashes are 64-bit polynomials of the bytes with a
bit mixer on top; users that need certainty compare the words themselves.
Chunks of at most ``CHUNK`` bytes bound the memory; one longer text is a chunk
of its own.
"""

from __future__ import annotations

import ctypes
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15          # odd, so that it has an inverse modulo 2**64
WORD_BASE = 0xC2B2AE3D27D4EB4F

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size, np.uint64)
            done, step = 1, b
            while done < size:
                more = min(done, size - done)
                p[done:done + more] = p[:more] * np.uint64(step)
                done, step = done + more, step * step % (1 << 64)
            out.append(p)
        have = _POWERS[base] = (out[0], out[1])
    return have[0], have[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixer, so that sums of hashes and low bits are well spread."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:end]`` for many spans, in one running sum."""
    p, inv = _powers(base, len(values) + 1)
    run = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[:len(values)], out=run[1:])
    return mix((run[ends] - run[starts]) * inv[starts])


def text_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null text is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.type not in (pa.binary(), pa.large_binary()):
        arr = arr.cast(pa.binary() if pa.types.is_string(arr.type) else pa.large_binary())
    arr = arr.cast(pa.large_binary())
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = arr.buffers()
    offsets = np.frombuffer(offs, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    if arr.null_count:
        size = np.diff(offsets)
        assert not size[arr.is_null().to_numpy(zero_copy_only=False)].any()
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def doc_chunks(offsets: np.ndarray, size: int = CHUNK):
    """Ranges of texts with at most ``size`` bytes, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def give_back() -> None:
    """Unused memory of the worker's allocators back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):              # another C library keeps what it has
        pass


def releasing(run):
    """A batch function that gives unused memory back at its end, so that what
    one stage's arrays took does not stay with a reused worker beside the next's."""
    def wrapped(batches):
        yield from run(batches)
        give_back()
    return wrapped


def byte_set(pred) -> np.ndarray:
    return np.array([bool(pred(b)) for b in range(256)])


#: words of anything but white space (\x20 \x09-\x0D)
NOT_SPACE = byte_set(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: words of ASCII letters, digits and every character beyond ASCII
LETTER_DIGIT = byte_set(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A)
#: A-Z in lower case, other bytes as they are
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


@dataclass
class Words:
    data: np.ndarray      # bytes of the chunk
    docs: np.ndarray      # n + 1 offsets of the texts in data
    starts: np.ndarray    # of the words
    ends: np.ndarray
    first: np.ndarray     # n + 1: number of words before each text

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def find_words(data: np.ndarray, docs: np.ndarray, is_word: np.ndarray) -> Words:
    w = is_word[data]
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[docs] = True
    cut[0] = cut[n] = True
    edge = np.empty(n + 1, bool)            # a word may start or end here
    edge[1:n] = w[1:] != w[:-1]
    edge[0] = edge[n] = True
    edge |= cut
    starts = np.flatnonzero(edge[:n] & w)
    ends = np.flatnonzero(edge[1:] & w) + 1
    return Words(data, docs, starts, ends, np.searchsorted(starts, docs))


def word_hashes(ws: Words, fold: np.ndarray) -> np.ndarray:
    return span_hash(fold[ws.data].astype(np.uint64) + np.uint64(1), ws.starts, ws.ends, BASE)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; the last k - 1 are short of words
    and hold no meaning, like those that cross the end of a text."""
    out = np.zeros(len(h), np.uint64)
    m = len(h) - k + 1
    if m > 0:
        p, _ = _powers(WORD_BASE, k)
        acc = np.zeros(m, np.uint64)
        for j in range(k):
            acc += h[j:j + m] * p[j]
        out[:m] = mix(acc)
    return out


def whole_windows(first: np.ndarray, k: int) -> np.ndarray:
    """Positions of words from which k words lie in the same text."""
    n = int(first[-1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return np.flatnonzero(left >= k)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each of the consecutive ranges of ``bounds``."""
    run = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=run[1:])
    return run[bounds[1:]] - run[bounds[:-1]]


def list_array(values, counts: np.ndarray) -> pa.ListArray:
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), values if isinstance(values, (pa.Array,)) else pa.array(values))


# XXH64 of many spans at once. Fixed values of the public algorithm:
_X1, _X2, _X3, _X4, _X5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: longer spans are few and are hashed one by one
_LONG_SPAN = 512


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc, lane):
    return _rotl(acc + lane * _X2, 31) * _X1


def _xxh64_equal_length(lanes8, lanes4, data, at: np.ndarray, size: int, seed: int) -> np.ndarray:
    """XXH64 of ``data[p:p + size]`` for every p of ``at``."""
    s = np.uint64(seed)
    done = 0
    if size >= 32:
        with np.errstate(over="ignore"):
            acc = [np.full(len(at), v, np.uint64) for v in (s + _X1 + _X2, s + _X2, s, s - _X1)]
        while size - done >= 32:
            acc = [_round(a, lanes8[at + (done + 8 * i)]) for i, a in enumerate(acc)]
            done += 32
        h = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
        zero = np.uint64(0)
        for a in acc:
            h = (h ^ _round(zero, a)) * _X1 + _X4
    else:
        with np.errstate(over="ignore"):
            h = np.full(len(at), s + _X5, np.uint64)
    h = h + np.uint64(size)
    while size - done >= 8:
        h = _rotl(h ^ _round(np.uint64(0), lanes8[at + done]), 27) * _X1 + _X4
        done += 8
    if size - done >= 4:
        h = _rotl(h ^ (lanes4[at + done].astype(np.uint64) * _X1), 23) * _X2 + _X3
        done += 4
    while done < size:
        h = _rotl(h ^ (data[at + done].astype(np.uint64) * _X5), 11) * _X1
        done += 1
    h ^= h >> np.uint64(33)
    h *= _X2
    h ^= h >> np.uint64(29)
    h *= _X3
    return h ^ (h >> np.uint64(32))


def xxh64_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of ``data[start:end]`` for many spans, by groups of equal length."""
    import xxhash

    out = np.zeros(len(starts), np.uint64)
    size = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes8 = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    lanes4 = np.ndarray((len(padded) - 3,), "<u4", padded, 0, (1,))
    order = np.argsort(np.minimum(size, _LONG_SPAN + 1).astype(np.uint16), kind="stable")
    sorted_size = np.minimum(size, _LONG_SPAN + 1)[order]
    cuts = np.flatnonzero(np.diff(sorted_size)) + 1
    for group in np.split(order, cuts):
        if not len(group):
            continue
        n = int(size[group[0]])
        if n > _LONG_SPAN:
            out[group] = [xxhash.xxh64_intdigest(padded[a:b].tobytes(), seed) for a, b in zip(starts[group], ends[group])]
        else:
            out[group] = _xxh64_equal_length(lanes8, lanes4, padded, starts[group], n, seed)
    return out


def joined_words(ws: Words, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words one after the other with a space behind each: bytes, and the
    new starts and ends of the words."""
    size = ws.ends - ws.starts
    starts = np.concatenate([[0], np.cumsum(size + 1)]).astype(np.int64)
    out = np.full(int(starts[-1]), 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[starts[1:] - 1] = False
    held = np.zeros(len(ws.data) + 1, np.int8)
    held[ws.starts] = 1
    held[ws.ends] -= 1
    out[inside] = fold[ws.data[np.cumsum(held[:-1], dtype=np.int8).astype(bool)]]
    return out, starts[:-1], starts[:-1] + size


_LANE = np.uint64(0x0101010101010101)


def bit_counts(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits (lowest first) is set in every range of
    ``bounds``: eight counters share one word, for at most 255 values."""
    n = len(bounds) - 1
    out = np.zeros((n, 64), np.int64)
    size = np.diff(bounds)
    full = np.flatnonzero(size)
    if not len(full):
        return out
    parts = (size[full] + 254) // 255
    owner = np.repeat(full, parts)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    at = bounds[owner] + 255 * step
    counts = np.empty((len(at), 64), np.uint8)
    for k in range(8):
        counts[:, k::8] = np.add.reduceat((values >> np.uint64(k)) & _LANE, at).view(np.uint8).reshape(-1, 8)
    out[full] = np.add.reduceat(counts, np.cumsum(parts) - parts, axis=0, dtype=np.int64)
    return out
