"""Operator 4: near-duplicate lines by a segment-partition edit join.

If two lines are within ``edits`` edits and one of them is cut into edits + 1
segments, at least one segment stands unchanged in the other, at a place that
the lengths and the segment's number confine.  Lines are indexed by their
segments and probed with the substrings in those places; candidates pass a
letter-parity bound inside the join and are verified by a banded bit-parallel
edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import sketch
from ledgerline.llm.components import connected_components
from ledgerline.llm.tables import drop, settle, spill
from ledgerline.llm.textscan import mix, pieces, running_sums, sum_hashes, utf8

#: (least code points, edits) by ascending length: the tolerance of a pair is its shorter line's.
Classes = tuple[tuple[int, int], ...]

#: Tolerance of lines below 24 code points: one edit from 8 on.  In a still shorter line one edit is over
#: an eighth of it, another item or number and no near copy.
SHORTER: Classes = ((8, 1),)

KEY_SCHEMA = "key long, id long, parity long, less int"


def segments(length: np.ndarray, edits: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of segment ``i`` of lines of ``length``: even sizes, the longer ones last."""
    parts = edits + 1
    size, longer = length // parts, length % parts
    short = parts - longer
    return i * size + np.maximum(0, i - short), size + (i >= short)


def _ranges(classes: Classes) -> list[tuple[int, int, int]]:
    """(least length, length before which the class ends, edits)."""
    ends = [least for least, _ in classes[1:]] + [1 << 62]
    return [(least, end, edits) for (least, edits), end in zip(classes, ends, strict=True)]


def _keys(classes: Classes, probe: bool):
    """Index keys of each line, or its probe keys with the length difference ``less`` they ask for.

    A key holds the length of the indexed line, so keys of two classes never meet.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter_class = (mix(np.arange(0x110000, dtype=np.uint64)) >> np.uint64(58)).astype(np.int64)
        for b in pieces(batches, text="line", limit=1 << 20):
            raw, bounds = utf8(b.column(1))
            data = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
            ids = b.column(0).to_numpy(zero_copy_only=False)
            n = len(ids)
            # code points: bytes that continue none
            before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            length = np.diff(before[bounds])
            begin = np.cumsum(length) - length
            # parity of the count of each letter class, one bit a class
            odd = np.bincount(np.repeat(np.arange(n) * 64, length) + letter_class[data], minlength=64 * n).reshape(-1, 64) & 1
            parity = (odd.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
            sums = running_sums(data)  # once for the segments of all classes, lengths and shifts
            out: list[list[np.ndarray]] = [[], [], [], []]

            def emit(rows, start, size, other, i, less):
                at = begin[rows] + start  # noqa: B023
                h = sum_hashes(sums, at, at + size)  # noqa: B023
                key = mix(h ^ mix((other * 64 + i).astype(np.uint64)))
                for column, v in zip(out, (key.view(np.int64), ids[rows], parity[rows].view(np.int64), np.full(len(rows), less, dtype=np.int32)), strict=True):  # noqa: B023
                    column.append(v)

            for least, end, edits, i in ((*c, i) for c in _ranges(classes) for i in range(c[2] + 1)):
                if not probe:
                    rows = np.flatnonzero((length >= least) & (length < end))
                    start, size = segments(length[rows], edits, i)
                    emit(rows, start, size, length[rows], i, 0)
                    continue
                for less in range(edits + 1):  # probes for lines of the same length or shorter ones
                    other = length - less
                    start, size = segments(other, edits, i)
                    low = np.maximum(0, np.maximum(start - i, start + less - (edits - i)))
                    high = np.minimum(length - size, np.minimum(start + i, start + less + (edits - i)))
                    ours = (other >= least) & (other < end)
                    for shift in range(-edits, 2 * edits + 1):
                        at = start + shift
                        rows = np.flatnonzero(ours & (at >= low) & (at <= high))
                        if len(rows):
                            emit(rows, at[rows], size[rows], other[rows], i, less)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["key", "id", "parity", "less"])

    return run


def within(pairs: list[tuple[np.ndarray, np.ndarray]], edits: int) -> np.ndarray:
    """Whether each pair of code-point arrays is within ``edits`` edits.

    Bit d + edits of state e says that the first t points of the one and the
    first t + d of the other match with at most e edits; all pairs advance
    together, one point a step, and leave when their text ends.
    """
    n = np.array([len(b) for _, b in pairs], dtype=np.int64)
    m = np.array([len(a) for a, _ in pairs], dtype=np.int64)
    order = np.argsort(-n, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    n, m = n[order], m[order]
    a = np.full((len(pairs), int(m.max(initial=0)) + 2 * edits + 1), 0xFFFFFFFF, dtype=np.uint32)
    b = np.zeros((max(1, int(n.max(initial=0))), len(pairs)), dtype=np.uint32)
    for r, i in enumerate(order):
        a[r, edits : edits + m[r]] = pairs[i][0]
        b[: n[r], r] = pairs[i][1]
    a = np.ascontiguousarray(a.T)
    width = 2 * edits + 1
    band = np.uint64((1 << width) - 1)
    one = np.uint64(1)
    state = [np.full(len(pairs), ((1 << (e + 1)) - 1) << edits, dtype=np.uint64) for e in range(edits + 1)]
    for t in range(int(n.max(initial=0))):
        k = int(np.searchsorted(-n, -t, side="left"))  # pairs with more than t points
        now = b[t, :k]
        same = np.zeros(k, dtype=np.uint64)
        for d in range(min(width, len(a) - t)):
            same |= (a[t + d, :k] == now).astype(np.uint64) << np.uint64(d)
        below_old = below_new = None
        for e in range(edits + 1):
            old = state[e][:k].copy()
            new = old & same
            if below_old is not None:
                new |= below_old | (below_old >> one) | ((below_new << one) & band)
            state[e][:k] = new
            below_old, below_new = old, new
    gap = m - n + edits
    ok = (gap >= 0) & (gap < width)
    bit = (state[edits] >> np.clip(gap, 0, 63).astype(np.uint64)) & one
    return (ok & (bit == 1))[rank]


def _verify(classes: Classes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for p in pieces([whole], text="tb", limit=1 << 20):
                texts = [[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4") for t in p.column(c).to_pylist()] for c in (2, 3)]
                pairs = list(zip(*texts, strict=True))
                sizes = np.array([len(x) for _, x in pairs])
                shorter = np.array([min(len(a), len(b)) for a, b in pairs])
                good = np.zeros(len(pairs), dtype=bool)
                order, at = np.argsort(sizes), 0
                while at < len(order):  # pairs of like length share a step; the tables stay small
                    to = at + 1
                    while to < len(order) and (to + 1 - at) * (sizes[order[to]] + 8) <= 1 << 21:
                        to += 1
                    for least, end, edits in _ranges(classes):
                        some = [i for i in order[at:to] if least <= shorter[i] < end]
                        if some:
                            good[some] = within([pairs[i] for i in some], edits)
                    at = to
                yield pa.RecordBatch.from_arrays([p.column(0), p.column(1)], ["a", "b"]).filter(pa.array(good))

    return run


def line_links(lines: DataFrame, classes: Classes = ((3, 2),)) -> DataFrame:
    """All links (a, b) between distinct ``lines(id, line)``, a < b: within the edits of the shorter line's class.

    A class begins at more code points than its edits; lines below the first class have no links.
    """
    if any(least <= edits for least, edits in classes) or list(classes) != sorted(classes):
        raise ValueError(f"classes by ascending length, each from more than its edits on: {classes}")
    edits = max(e for _, e in classes)
    index = lines.mapInArrow(_keys(classes, False), KEY_SCHEMA).select("key", F.col("id").alias("a"), F.col("parity").alias("pa"))
    probes = lines.mapInArrow(_keys(classes, True), KEY_SCHEMA).select(F.col("key").alias("k"), F.col("id").alias("b"), F.col("parity").alias("pb"), "less")
    # lines of equal length probe each other; one direction is enough
    once = ((F.col("less") > 0) & (F.col("a") != F.col("b"))) | (F.col("a") < F.col("b"))
    # an edit changes the parity of two letter classes at most
    alike = F.bit_count(F.col("pa").bitwiseXOR(F.col("pb"))) <= 2 * edits
    pairs = index.join(probes, (F.col("key") == F.col("k")) & once & alike)
    pairs = spill(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "line-pairs")
    settle(lines.sparkSession)
    wanted = sketch.id_filter(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), "id")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(wanted(b.column(0).to_numpy(zero_copy_only=False))))

    texts = spill(lines.mapInArrow(keep, "id long, line string"), "line-texts")
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("ta")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("line").alias("tb")), "b").select("a", "b", "ta", "tb"))
    return both.mapInArrow(_verify(classes), "a long, b long")


def dedup_lines(docs: DataFrame, edits: int = 2, min_chars: int = 24, id_col: str = "doc_id", text_col: str = "text",
                shorter: Classes = ()) -> DataFrame:
    r"""One row per document: n_lines, n_exact, n_near, dropped.

    Lines are the \n-split pieces with a word in them.  Equal lines, and lines
    that links connect, are one class: two lines link within ``edits`` edits
    if the shorter has ``min_chars`` code points or more, below that within
    the edits that the classes ``shorter`` give its length (see ``SHORTER``).
    A class's first line in order of (doc_id, row, line
    number) stays, the others are dropped: n_exact of them equal an earlier
    line of the corpus or of their document, n_near only resemble one.
    ``dropped`` lists their line numbers (from 0).

    Null and empty texts have no lines.  Documents with equal ids are told
    apart by row; null ids come first.  Other columns are ignored.  Lines are
    known by a 64-bit hash.
    """
    line = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("_l"))
    classes = (*shorter, (min_chars, edits))
    long_lines = rows.select(F.explode("_l").alias("line")).where(F.length("line") >= classes[0][0]).where(line(F.col("line"))).distinct()
    lines = spill(long_lines.select(F.xxhash64("line").alias("id"), "line"), "lines")
    known = spill(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                              F.transform("_l", lambda x: F.when(line(x), F.xxhash64(x))).alias("ids")), "line-ids")
    # the shuffles of the lines, then of their keys, go before the next ones come; a job later, when nothing holds their plan
    settle(docs.sparkSession)
    links = spill(line_links(lines, classes), "line-links")
    drop(lines)
    settle(docs.sparkSession)
    found = connected_components(links)
    where = known.select("row", "doc_id", F.posexplode("ids").alias("line_no", "id")).where("id is not null")
    place = F.struct("doc_id", "row", "line_no")
    firsts = where.groupBy("id").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    # lines that neither recur nor link stay and need no more work
    firsts = spill(firsts.join(found, "id", "left").where("n > 1 or component is not null")
                   .select("id", "first", F.coalesce("component", "id").alias("class")), "line-firsts")
    heads = firsts.groupBy("class").agg(F.min("first").alias("head"))
    heads = spill(firsts.join(heads, "class").select("id", "first", "head"), "line-heads")
    dropped = (where.join(heads, "id").where(~place.eqNullSafe(F.col("head")))
               .groupBy("row").agg(F.sort_array(F.collect_list("line_no")).alias("dropped"),
                                   F.sum((~place.eqNullSafe(F.col("first"))).cast("long")).alias("n_exact"),
                                   F.sum(place.eqNullSafe(F.col("first")).cast("long")).alias("n_near")))
    zero = F.lit(0).cast("long")
    return (known.select("row", "doc_id", F.size(F.filter("ids", lambda x: x.isNotNull())).cast("long").alias("n_lines"))
            .join(dropped, "row", "left")
            .select("doc_id", "n_lines", F.coalesce("n_exact", zero).alias("n_exact"), F.coalesce("n_near", zero).alias("n_near"),
                    F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")))


def drop_lines(text, dropped):
    r"""Column: ``text`` without the \n-split lines numbered in ``dropped``."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(dropped, i)), "\n")
