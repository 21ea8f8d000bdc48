"""Adaptive context-mixing range coder for token ids.

A list of ids is cut into blocks of ``BLOCK`` ids. Every block starts from the
same state and is coded by itself, so any block can be read alone; each has a
CRC-32 of its ids. All blocks of a list advance together, one id of each at a
time, as array operations.

For each id three predictions are mixed: order 2 (the id that last followed the
two ids before), order 1 (the id that last followed the one before) and order 0
(adaptive frequencies of magnitude classes of ids). One symbol of an adaptive
frequency table says which prediction holds: order 2, order 1, or else a class,
whose remaining bits follow. There is a table for each state of the two higher
orders (unknown, order 1 only, both but different, agreeing), so their weights
adapt to how far they can be trusted. The symbols drive a range coder with carry
over 32-bit digits.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 2048
MAGIC = b"TKR3"
STEP = 12                     # added to a symbol's frequency; BLOCK * STEP + the first total stays below 2**15
FIRST = 4                     # first frequency of every symbol
SLOTS = 256                   # of each block's order-1 and order-2 tables; a power of two
# Order 0: ids of 16 bits in classes of 2**bits neighbours, low ones (single bytes
# and frequent pairs) finer.
CLASS_BITS = (3, 3, 4, 5, 6, 7, 8, 10, 11, 12, 14, 15, 14)

_ALL = np.uint64((1 << 64) - 1)
_LEAST = np.uint64(1 << 32)
_DIGIT = np.uint64(32)
_LOW32 = np.uint64((1 << 32) - 1)
SYMBOLS = len(CLASS_BITS) + 2
CLASS_BASE = np.concatenate([[0], np.cumsum(np.left_shift(1, np.array(CLASS_BITS)))])[:-1]
CLASS_OF = np.repeat(np.arange(len(CLASS_BITS)), np.left_shift(1, np.array(CLASS_BITS)))[:1 << 16] + 2     # the symbol of every id
_BITS = np.concatenate([np.zeros(2), CLASS_BITS]).astype(np.uint64)      # by symbol
_BASE = np.concatenate([np.zeros(2), CLASS_BASE]).astype(np.int64)
# A row of running frequencies: before each symbol, the total, then padding that
# no value reaches. Rows are moved as single elements of ROW bytes.
WIDTH = -(-(SYMBOLS + 1) // 8) * 8
_ROW = np.dtype((np.void, 2 * WIDTH))
_START = np.where(np.arange(WIDTH) <= SYMBOLS, np.arange(WIDTH) * FIRST, 32767).astype(np.int16)
# What a symbol adds to the running frequencies behind it.
_RAISE = np.where((np.arange(WIDTH)[None, :] > np.arange(SYMBOLS)[:, None]) & (np.arange(WIDTH) <= SYMBOLS)[None, :],
                  STEP, 0).astype(np.int16)
_RAISE_ROWS = _RAISE.view(_ROW).ravel()
_BYTE_SUM = np.uint64(0x0101010101010101)
_NONE = 0xFFFF                # nothing followed yet (or the last id: both sides read it alike)


class _Model:
    """Predictions and frequency tables of n blocks side by side."""

    def __init__(self, n: int):
        lane = np.arange(n)
        self.slot, self.four, self.wide = lane * SLOTS, lane * 4, lane * WIDTH
        self.rows = np.tile(_START, (4 * n, 1)).view(_ROW).ravel()
        self.one = np.full(n * SLOTS, _NONE, np.uint16)
        self.two = np.full(n * SLOTS, _NONE, np.uint16)
        self.c1 = np.zeros(n, np.int32)
        self.at1, self.mixed = self.slot.copy(), np.zeros(n, np.int32)

    def predict(self, m: int):
        """Both predictions for the first m blocks; their table rows are in ``cum``."""
        if m < len(self.c1):
            self.c1, self.at1, self.mixed = self.c1[:m], self.at1[:m], self.mixed[:m]
            self.slot, self.four, self.wide = self.slot[:m], self.four[:m], self.wide[:m]
        self.at2 = self.slot + ((self.mixed ^ (self.c1 * 0x5BD1E5)) & (SLOTS - 1))
        one, two = self.one.take(self.at1), self.two.take(self.at2)
        self.row = self.four + (two != _NONE)
        self.row += self.row
        self.row -= self.four
        self.row += two == one
        self.cum = self.rows.take(self.row).view(np.int16)
        return one, two

    def total(self):
        return self.cum[SYMBOLS::WIDTH].astype(np.uint64)

    def find(self, value):
        """The symbol in whose range each value lies."""
        below = (self.cum.reshape(-1, WIDTH) <= value[:, None]).view(np.uint64)
        count = below[:, 0].copy()
        for k in range(1, WIDTH // 8):
            count += below[:, k]
        count *= _BYTE_SUM
        return (count >> np.uint64(56)).astype(np.int64) - 1

    def bounds(self, symbol):
        """Running frequency before each symbol, and its own frequency."""
        at = self.wide + symbol
        start = self.cum.take(at)
        at += 1
        return start.astype(np.uint64), (self.cum.take(at) - start).astype(np.uint64)

    def learn(self, symbol, ids):
        """``ids`` (32 bits) followed; the next contexts are theirs."""
        narrow = ids.astype(np.uint16)
        self.cum += _RAISE_ROWS.take(symbol).view(np.int16)
        self.rows[self.row] = self.cum.view(_ROW)
        self.one[self.at1] = narrow
        self.two[self.at2] = narrow
        self.mixed = (self.c1 * 0x2C1B3C) >> 5
        self.c1 = ids
        self.at1 = self.slot + (((ids * 0x297A2D) >> 8) & (SLOTS - 1))


def _active(sizes: np.ndarray) -> np.ndarray:
    """How many blocks (longest first) have an id at each step."""
    steps = int(sizes[0]) if len(sizes) else 0
    return np.searchsorted(-sizes, -np.arange(steps), "left")


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """The coded blocks of ``ids`` (of 16 bits)."""
    n = -(-len(ids) // block)
    if not n:
        return []
    sizes = np.full(n, block)
    sizes[-1] = len(ids) - (n - 1) * block
    flat = np.zeros(n * block, np.int32)
    flat[:len(ids)] = ids
    grid = np.ascontiguousarray(flat.reshape(n, block).T)
    model, done = _Model(n), []
    low, span = np.zeros(n, np.uint64), np.full(n, _ALL)
    room = block * 5 // 4 + 8
    digits = np.zeros(n * room, np.uint64)                  # each block's digits stand together
    used = first = np.arange(n) * room
    for t, m in enumerate(_active(sizes).tolist()):
        now = grid[t, :m]
        if m < len(low):                                    # the last block is shorter: its state stays as it is
            done.append((low[m:], used[m:]))
            low, span, used = low[:m], span[:m], used[:m]
        one, two = model.predict(m)
        symbol = CLASS_OF.take(now)
        symbol[one == now] = 1
        symbol[two == now] = 0
        start, size = model.bounds(symbol)
        r = span // model.total()
        add = r * start
        r *= size
        r >>= _BITS.take(symbol)
        rest = now - _BASE.take(symbol)
        rest *= symbol > 1
        rest = rest.view(np.uint64)
        rest *= r
        add += rest
        add += low
        over = np.flatnonzero(add < low)
        if len(over):
            digits[used[over] - 1] += np.uint64(1)
        low, span = add, r
        full = span < _LEAST
        out = np.flatnonzero(full)
        digits[used[out]] = low[out] >> _DIGIT
        low[out] <<= _DIGIT
        span[out] <<= _DIGIT
        used = used + full
        model.learn(symbol, now)
    for rest_low, rest_used in reversed(done):
        low, used = np.concatenate([low, rest_low]), np.concatenate([used, rest_used])
    for k in (32, 0):                                       # the last two digits
        digits[used] = (low >> np.uint64(k)) & _LOW32
        used = used + 1
    digits, used = digits.reshape(n, room), used - first
    for c in range(int(used.max()) - 1, 0, -1):
        digits[:, c - 1] += digits[:, c] >> _DIGIT
    out = digits[:, :int(used.max())].astype(np.uint32).astype(">u4")
    return [out[i, :used[i]].tobytes() for i in range(n)]


def decode_blocks(blocks: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """The ids of coded blocks that hold ``sizes`` ids, the longest first."""
    n = len(blocks)
    if not n:
        return np.zeros(0, np.uint32)
    lengths = np.array([len(b) // 4 for b in blocks])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    stream = np.concatenate([np.frombuffer(b"".join(blocks), ">u4").astype(np.uint64), np.zeros(8, np.uint64)])
    model = _Model(n)
    at = starts[:-1] + 2
    code = (stream.take(at - 2, mode="clip") << _DIGIT) | stream.take(at - 1, mode="clip")     # damaged data may run on
    span = np.full(n, _ALL)
    out = np.zeros((int(sizes[0]), n), np.int32)
    for t, m in enumerate(_active(sizes).tolist()):
        if m < len(code):
            code, span, at = code[:m], span[:m], at[:m]
        one, two = model.predict(m)
        total = model.total()
        r = span // total
        value = np.minimum(code // r, total - np.uint64(1)).astype(np.int16)
        symbol = model.find(value)
        start, size = model.bounds(symbol)
        code = code - r * start
        r *= size
        r >>= _BITS.take(symbol)
        rest = code // r
        code -= r * rest
        span = r
        more = np.flatnonzero(span < _LEAST)
        code[more] = (code[more] << _DIGIT) | stream.take(at[more], mode="clip")
        span[more] <<= _DIGIT
        at[more] += 1
        ids = np.where(symbol > 1, (_BASE.take(symbol) + rest.view(np.int64)).astype(np.int32), np.where(symbol == 1, one, two))
        out[t, :m] = ids
        model.learn(symbol, ids)
    return np.concatenate([out[:s, i] for i, s in enumerate(sizes.tolist())]).astype(np.uint32)


# A segment is MAGIC, five counts (ids, ids of a block, blocks of a plane, planes,
# bytes of coded blocks; little-endian unsigned 32-bit), then the bytes of each
# block of each plane, the CRC-32 of the ids of each block, and the blocks. A
# plane holds 16 bits of every id; ids below 2**16 have one, others two.
_HEAD = struct.Struct("<4s5I")


def pack_segment(ids: np.ndarray, block: int = BLOCK) -> bytes:
    raw = ids.astype("<u4")
    planes = [raw & np.uint32(0xFFFF)] + ([raw >> np.uint32(16)] if len(ids) and int(ids.max()) >> 16 else [])
    blocks = [encode_blocks(p, block) for p in planes]
    n = len(blocks[0])
    sums = [zlib.crc32(raw[i * block:(i + 1) * block].tobytes()) for i in range(n)]
    table = np.array([len(b) for plane in blocks for b in plane] + sums, "<u4").tobytes()
    body = b"".join(b for plane in blocks for b in plane)
    return _HEAD.pack(MAGIC, len(ids), block, n, len(planes), len(body)) + table + body


def unpack_segment(data: bytes) -> np.ndarray:
    """The ids of a segment; raises ValueError if it is damaged."""
    if len(data) < _HEAD.size:
        raise ValueError("truncated segment")
    magic, count, block, n, planes, size = _HEAD.unpack_from(data)
    head = _HEAD.size + 4 * n * (planes + 1)
    if magic != MAGIC or len(data) != head + size or not block or n != -(-count // block) or planes not in (1, 2):
        raise ValueError("not a segment, or truncated")
    table = np.frombuffer(data, "<u4", n * (planes + 1), _HEAD.size).reshape(planes + 1, n)
    ends = head + np.cumsum(table[:planes].astype(np.int64).ravel()).reshape(planes, n)
    sizes = np.minimum(block, count - block * np.arange(n))
    ids = np.zeros(count, np.uint32)
    for p in range(planes):
        plane = decode_blocks([data[e - s:e] for e, s in zip(ends[p].tolist(), table[p].tolist())], sizes)
        ids |= plane << np.uint32(16 * p)
    raw = ids.astype("<u4")
    for i, want in enumerate(table[planes].tolist()):
        if zlib.crc32(raw[i * block:(i + 1) * block].tobytes()) != want:
            raise ValueError(f"checksum of block {i} does not match")
    return ids
