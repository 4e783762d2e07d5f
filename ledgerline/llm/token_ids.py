"""Token ids of whole texts by a public byte-level BPE, a piece at a time.

Merges never cross the pre-tokeniser's borders, so a text can be cut at borders
that are certain from the bytes around them; each distinct piece is encoded by
the tokenizers library once and its ids are reused.  Texts that the byte rules
don't cover (other white space than ASCII's, special-token strings) are encoded
whole by the library.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from ledgerline.llm.textscan import span_hashes, utf8

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BREAK = _SPACE.copy()
_BREAK[0x20] = False
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(0x21, 0x7F) if not _ALNUM[c] and c != 0x27]] = True
#: First bytes of white space beyond ASCII, in UTF-8.
_RARE = np.zeros(256, dtype=bool)
_RARE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
#: Bytes that are, or may begin, white space of any kind, the separators 1C to 1F among them.
_NOT_PLAIN = _SPACE | _RARE
_NOT_PLAIN[0x1C:0x20] = True
_WIDE_SPACE = {chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)}

SLOT_BITS = 21
MAX_PIECES = 1 << 20


class PieceEncoder:
    """Encodes batches of texts; keeps the ids of pieces between batches (bounded)."""

    def __init__(self, path: str, special: tuple[str, ...] = ("<|endoftext|>",)):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [s.encode() for s in special]
        self.newline = self.encode_whole(["\n"])[0]
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
        self.piece = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def encode_whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, number, ids) of distinct pieces.  Simple ones go joined by newlines, whose id they can't hold."""
        at, size = np.zeros(len(start), dtype=np.int64), np.zeros(len(start), dtype=np.int64)
        # simple: one word, after a blank at most; no other byte that is or may begin white space
        length = end - start
        before = np.cumsum(length) - length
        raw = data[np.repeat(start - before, length) + np.arange(int(length.sum()))]
        blank = data[start] == 0x20
        odd = np.concatenate([[0], np.cumsum(_NOT_PLAIN[raw])])
        plain = (odd[before + length] - odd[before] == blank) & (length > blank)
        text = lambda i: data[start[i] : end[i]].tobytes().decode("utf-8", "replace")
        rare = np.concatenate([[0], np.cumsum(_RARE[raw])])
        for i in np.flatnonzero(rare[before + length] > rare[before]):  # perhaps no white space after all
            t = text(i)
            word = t.split()
            plain[i] = len(word) == 1 and t in (word[0], " " + word[0])
        if len(self.newline) != 1:
            plain[:] = False
        simple, rest = np.flatnonzero(plain), np.flatnonzero(~plain).tolist()
        # a newline before each simple piece
        lead = np.repeat(plain, length)
        joined = np.insert(raw[lead], np.cumsum(length[simple]) - length[simple], 0x0A)
        bounds = np.concatenate([[0], np.cumsum(length[simple] + 1)])
        groups = [simple[k : k + 256] for k in range(0, len(simple), 256)]
        parts = [joined[bounds[k] : bounds[min(k + 256, len(simple))]].tobytes().decode("utf-8", "replace") for k in range(0, len(simple), 256)]
        flat, base = [], 0
        for group, ids in zip(groups, self.encode_whole(parts), strict=True):
            marks = np.flatnonzero(ids == self.newline[0])
            if len(marks) != len(group):
                rest += group.tolist()
                continue
            at[group] = base + marks + 1
            size[group] = np.diff(marks, append=len(ids)) - 1
            flat.append(ids)
            base += len(ids)
        for i, ids in zip(rest, self.encode_whole([text(i) for i in rest]), strict=True):
            at[i], size[i] = base, len(ids)
            flat.append(ids)
            base += len(ids)
        return at, size, np.concatenate(flat)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, bounds of each text)."""
        data, offsets = utf8(column)
        n = len(offsets) - 1
        whole = np.zeros(n, dtype=bool)
        at = np.flatnonzero(_RARE[data])
        if len(at):
            for width in (2, 3):
                ok = at[at + width <= len(data)]
                lead = (data[ok] == 0xC2) == (width == 2)
                for i in ok[lead][np.isin(data[ok[lead] + 1], [0x85, 0xA0, 0x9A, 0x80, 0x81])]:
                    if data[i : i + width].tobytes() in _WIDE_SPACE:
                        whole[np.searchsorted(offsets, i, side="right") - 1] = True
        raw = data.tobytes() if self.special else b""
        for s in self.special:
            i = raw.find(s)
            while i >= 0:
                whole[np.searchsorted(offsets, i, side="right") - 1] = True
                i = raw.find(s, i + 1)
        idx, bounds = self._pieces(data, offsets)
        if whole.any():
            direct = self.encode_whole([data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in np.flatnonzero(whole)])
        sizes = self.size[idx]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.at[idx] - ends[:-1], sizes) + np.arange(ends[-1])]
        cut = ends[bounds]
        if not whole.any():
            return ids, cut
        parts = [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        for i, d in zip(np.flatnonzero(whole), direct, strict=True):
            parts[i] = d
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cached piece of each span of the texts, and the first span of each text."""
        n = len(data)
        if not n:
            return np.empty(0, dtype=np.int64), np.zeros(len(offsets), dtype=np.int64)
        space = _SPACE[data]
        cut = np.zeros(n, dtype=bool)
        # a white-space run begins after anything else
        cut[1:] = space[1:] & ~space[:-1]
        # after a mark that follows an ASCII letter or digit run
        cut[1:] |= _MARK[data[1:]] & _ALNUM[data[:-1]]
        # text after a single line break
        after = _BREAK[data]
        lone = after[1:-1] & ~space[:-2] & ~space[2:]
        cut[2:] |= lone
        firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
        at = firsts[(firsts + 1 < n)]
        at = at[after[at] & ~space[at + 1]] + 1
        cut[at] = True  # a single break that opens a text
        cut[firsts] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], n)
        h = span_hashes(data, start, end)
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        idx = np.where(self.keys[slot] == h, self.piece[slot], -1).astype(np.int64)
        missing = np.flatnonzero(idx < 0)
        if len(missing):
            if len(self.at) > MAX_PIECES:
                self.clear()
                missing = np.arange(len(h))
                idx[:] = -1
            fresh, first, back = np.unique(h[missing], return_index=True, return_inverse=True)
            spans = missing[first]
            places, sizes, ids = self._encode_pieces(data, start[spans], end[spans])
            base = len(self.at)
            self.at = np.concatenate([self.at, len(self.ids) + places])
            self.size = np.concatenate([self.size, sizes])
            self.ids = np.concatenate([self.ids, ids])
            idx[missing] = base + back.reshape(-1)
            slots = (fresh >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            # of new pieces that share a slot the first is held
            slots, first = np.unique(slots, return_index=True)
            self.keys[slots] = fresh[first]
            self.piece[slots] = base + first
        return idx, np.searchsorted(start, offsets)
