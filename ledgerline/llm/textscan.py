"""Vectorised scanning of Arrow string columns: word spans, word and shingle hashes.

Everything works on the UTF-8 bytes of a whole batch at once.  The word
patterns in use are byte classes (every byte of a non-ASCII code point belongs
to a word), so byte spans equal the code-point regex's matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing A-Z).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)

#: Texts are scanned in pieces of about this many bytes (whole texts only).
PIECE_BYTES = 2 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) < n:
        size = max(n, PIECE_BYTES)
        up, down = np.full(size, _BASE), np.full(size, _BASE_INVERSE)
        up[0] = down[0] = 1
        _POWERS = np.cumprod(up), np.cumprod(down)
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def running_sums(data: np.ndarray) -> np.ndarray:
    """The polynomial sum of ``data`` before each place and at its end."""
    up, _ = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def sum_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """`span_hashes` from the `running_sums`, which any number of calls can share."""
    _, down = _powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from one running polynomial sum."""
    return sum_hashes(running_sums(data), start, end)


class Words:
    """Words of consecutive texts: ``start``/``end`` bytes and ``first`` word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = is_word[data]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        cuts = offsets[offsets < len(data)]
        before[cuts] = False
        cuts = offsets[offsets > 0] - 1
        after[cuts] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        return span_hashes(self.data, self.start, self.end)

    def words(self, a: int, b: int) -> list[str]:
        """Words ``a`` to ``b`` (positions over all texts)."""
        raw = self.data
        return [raw[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(self.start[a:b], self.end[a:b], strict=True)]


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive words of one text, and the position of each first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + n]
    ok = np.ones(n, dtype=bool)
    ends = first[1:]
    for j in range(1, k):  # windows that would run into the next text
        at = ends - j
        ok[at[(at >= 0) & (at < n)]] = False
    # texts shorter than a window: their cuts fall before their own start
    at = np.flatnonzero(ok)
    text = np.searchsorted(first, at, side="right") - 1
    at = at[at + k <= first[text + 1]]
    return mix(out[at]), at


def utf8(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column (null: empty) and the offset of each text."""
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None and len(raw) else np.empty(0, dtype=np.uint8)
    return (_LOWER[data] if lower else data), offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of text (one text at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text)).fill_null("")
        wide = pa.types.is_large_string(column.type)
        ends = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def list_column(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the bound of each list."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32), pa.int32()), pa.array(values, kind))
