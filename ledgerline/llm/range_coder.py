"""Adaptive context-mixing range coder for token ids (numpy, many lanes at once).

A block is cut into lanes of consecutive ids that share one model.  At each
step every lane codes one id; then the model learns all of them.  Three
predictions are mixed: order 2 and order 1 (the id that last followed the same
two / one ids, with a confidence) and order 0 (adaptive counts of all ids).  How
much of the range the first two get is itself adaptive: it follows how often
they were right at the same pair of confidences.  The mixed distribution drives
a 64-bit range coder with carries that emits 32-bit words.  Model and coder
start afresh in each block, which carries CRC-32s of its ids and of its bytes.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMRB"
#: Ids of a block, and the most lanes it is cut into.
BLOCK_IDS = 1 << 22
MAX_LANES = 1 << 14
#: Order-0 counts are scaled to this total.
SCALE_BITS = 20
CONTEXT_BITS = 18

_U32 = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)
_MIN_RANGE = np.uint64(1 << 32)
_HEAD = struct.Struct("<4sIIIII")


class _Model:
    """The shared model of a block; coder and decoder take the same steps."""

    def __init__(self, vocabulary: int, lanes: int):
        self.vocabulary = vocabulary
        self.counts = np.zeros(vocabulary, dtype=np.int64)
        self.fresh: list[np.ndarray] = []  # ids since the last refresh
        self.slots = np.zeros(1, dtype=np.uint32)
        # predicted id * 4 + confidence, by context
        self.one = np.zeros(vocabulary, dtype=np.uint32)
        self.two = np.zeros(1 << CONTEXT_BITS, dtype=np.uint32)
        # contexts are held as indices, so that no look-up converts them
        self.prev1 = np.zeros(lanes, dtype=np.intp)
        self.key2 = np.zeros(lanes, dtype=np.intp)
        self.last = np.zeros(lanes, dtype=np.uint32)  # the ids of ``prev1``
        self.right = np.ones((16, 3), dtype=np.float64)
        self.right[:, 0] = 4
        self.step = 0
        self.refresh_at = 0

    def refresh(self, decoder: bool) -> None:
        """Rescale the order-0 counts: every id keeps one unit, the rest is shared."""
        if self.fresh:
            self.counts += np.bincount(np.concatenate(self.fresh), minlength=self.vocabulary)
            self.fresh = []
        spare = (1 << SCALE_BITS) - self.vocabulary
        total = max(1, int(self.counts.sum()))
        units = 1 + self.counts * spare // total
        units[int(self.counts.argmax())] += (1 << SCALE_BITS) - int(units.sum())
        self.units = units.astype(np.uint64)
        self.starts = np.zeros(self.vocabulary, dtype=np.uint64)
        np.cumsum(units[:-1], out=self.starts[1:].view(np.int64))
        if decoder:
            self.slots = np.repeat(np.arange(self.vocabulary, dtype=np.uint32), units)

    def predict(self, decoder: bool) -> None:
        """Predictions of the next step and their shares of the range."""
        if self.step == self.refresh_at:
            self.refresh(decoder)
            self.refresh_at = max(1, min(self.step * 2, self.step + 32))
        self.e2, self.e1 = self.two[self.key2], self.one[self.prev1]
        self.p2, self.p1 = self.e2 >> 2, self.e1 >> 2
        self.mixed = (((self.e2 & 3) << 2) | (self.e1 & 3)).astype(np.intp)
        base = (1 << SCALE_BITS) / self.right[:, 0]
        share = np.minimum(self.right * base[:, None], 60 << SCALE_BITS).astype(np.uint64) + np.uint64(1)
        self.m2 = share[:, 2].take(self.mixed)
        self.m1 = share[:, 1].take(self.mixed)

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """Take in the ids of a step (``hit1`` where order 1 alone was right)."""
        # neither, order 1 or order 2 right, by pair of confidences
        self.right += np.bincount(3 * self.mixed + hit1 + 2 * hit2, minlength=48).reshape(16, 3)
        self.fresh.append(ids)
        same1 = self.p1 == ids
        for table, key, entry, same in ((self.two, self.key2, self.e2, hit2), (self.one, self.prev1, self.e1, same1)):
            sure = entry & 3
            # right: surer; wrong: less sure, or replaced at no confidence (last lane wins)
            kept = entry + (sure < 3)
            lost = np.where(sure > 0, entry - np.uint32(1), ids << np.uint32(2))
            table[key] = np.where(same, kept, lost)
        self.key2 = ((self.last * np.uint32(0x9E3779B1) + ids * np.uint32(0x85EBCA6B)) >> np.uint32(32 - CONTEXT_BITS)).astype(np.intp)
        self.last, self.prev1 = ids, ids.astype(np.intp)
        self.step += 1


def _lanes(n: int) -> int:
    """Lanes of a block of ``n`` ids."""
    return max(1, min(MAX_LANES, n // 128, int(n ** 0.5) * 8))


def encode_block(ids: np.ndarray, vocabulary: int) -> bytes:
    """One block of at most `BLOCK_IDS` ids below ``vocabulary``."""
    n = len(ids)
    lanes = _lanes(n)
    steps = -(-n // lanes)
    padded = np.zeros(lanes * steps, dtype=np.uint32)
    padded[:n] = ids
    by_step = np.ascontiguousarray(padded.reshape(lanes, steps).T)
    del padded
    model = _Model(vocabulary, lanes)
    low, span = np.zeros(lanes, dtype=np.uint64), np.full(lanes, np.uint64(0xFFFFFFFFFFFFFFFF))
    words = np.zeros((lanes, steps + 2), dtype=np.uint32)
    at = np.zeros(lanes, dtype=np.int64)
    one = np.uint64(1 << SCALE_BITS)

    def carry(rows: np.ndarray) -> None:
        back = at[rows] - 1
        while len(rows):
            words[rows, back] += np.uint32(1)
            over = words[rows, back] == 0
            rows, back = rows[over], back[over] - 1

    for t in range(steps):
        now = by_step[t]
        model.predict(False)
        hit2 = model.p2 == now
        hit1 = (model.p1 == now) & ~hit2
        plain = ~(hit2 | hit1)
        m2, m1 = model.m2, model.m1
        start = np.where(plain, m2 + m1 + model.starts[now], np.where(hit2, np.uint64(0), m2))
        width = np.where(plain, model.units[now], np.where(hit2, m2, m1))
        unit = span // (m2 + m1 + one)
        before = low
        low = low + unit * start
        span = unit * width
        over = np.flatnonzero(low < before)
        if len(over):
            carry(over)
        out = np.flatnonzero(span < _MIN_RANGE)
        words[out, at[out]] = low[out] >> _U32
        at[out] += 1
        low[out] <<= _U32
        span[out] <<= _U32
        model.learn(now, hit2, hit1)
    rows = np.arange(lanes)
    words[rows, at] = low >> _U32
    words[rows, at + 1] = low & _LOW
    at += 2
    body = at.astype("<u4").tobytes() + words[np.arange(steps + 2) < at[:, None]].astype("<u4", copy=False).tobytes()
    del by_step
    fields = (n, lanes, vocabulary, zlib.crc32(np.ascontiguousarray(ids, dtype="<u4")))
    return _HEAD.pack(MAGIC, *fields, zlib.crc32(body, zlib.crc32(repr(fields).encode()))) + body


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block; a damaged block raises ValueError."""
    if len(block) < _HEAD.size or block[:4] != MAGIC:
        raise ValueError("not a block of the token file format")
    _, *fields, whole = _HEAD.unpack_from(block)
    if zlib.crc32(memoryview(block)[_HEAD.size:], zlib.crc32(repr(tuple(fields)).encode())) != whole:
        raise ValueError("block damaged")
    n, lanes, vocabulary, check = fields
    counts = np.frombuffer(block, "<u4", lanes, _HEAD.size).astype(np.int64)
    words = np.frombuffer(block, "<u4", offset=_HEAD.size + 4 * lanes)
    if int(counts.sum()) != len(words) or counts.min() < 2:
        raise ValueError("block cut short")
    steps = -(-n // lanes)
    at = np.cumsum(counts) - counts
    words = np.concatenate([words, np.zeros(1, "<u4")]).astype(np.uint64)
    code = (words[at] << _U32) | words[at + 1]
    at += 2
    end = len(words) - 1
    model = _Model(vocabulary, lanes)
    span = np.full(lanes, np.uint64(0xFFFFFFFFFFFFFFFF))
    by_step = np.empty((steps, lanes), dtype=np.uint32)
    one = np.uint64(1 << SCALE_BITS)
    for t in range(steps):
        model.predict(True)
        m2 = model.m2
        both = m2 + model.m1
        unit = span // (both + one)
        value = np.minimum(code // unit, both + one - np.uint64(1))
        hit2 = value < m2
        plain = value >= both
        rest = model.slots[np.where(plain, value - both, np.uint64(0))]
        now = np.where(plain, rest, np.where(hit2, model.p2, model.p1))
        hit1 = ~(plain | hit2)
        # an id that order 1 or 2 predicts is never coded by order 0
        start = np.where(plain, both + model.starts[now], np.where(hit2, np.uint64(0), m2))
        width = np.where(plain, model.units[now], np.where(hit2, m2, model.m1))
        code = code - unit * start
        span = unit * width
        need = np.flatnonzero(span < _MIN_RANGE)
        code[need] = (code[need] << _U32) | words[np.minimum(at[need], end)]
        at[need] += 1
        span[need] <<= _U32
        by_step[t] = now
        model.learn(now, hit2, hit1)
    ids = np.ascontiguousarray(by_step.T).reshape(-1)[:n]
    if zlib.crc32(np.ascontiguousarray(ids, dtype="<u4")) != check:
        raise ValueError("block checksum differs")
    return ids
