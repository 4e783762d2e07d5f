"""Fixed-size counting sketches of 64-bit hashes, merged by Spark, broadcast by bound."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 14
SCHEMA = "chunk int, counts binary"


def bucket(h: np.ndarray, bits: int, which: int = 0) -> np.ndarray:
    """Bucket of each hash; ``which`` picks independent bits of it."""
    return ((h >> np.uint64(64 - bits)) if which == 0 else (h & np.uint64((1 << bits) - 1))).astype(np.int64)


def to_rows(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's sketch as rows of packed chunks (empty chunks are left out)."""
    for c in range(0, len(counts), CHUNK):
        part = counts[c : c + CHUNK]
        if part.any():
            packed = zlib.compress(np.minimum(part.astype(np.uint64), 0xFFFFFFFF).astype("<u4").tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([c // CHUNK], pa.int32()), pa.array([packed], pa.binary())], ["chunk", "counts"])


def _merge(how: str):
    join = np.maximum if how == "max" else np.add

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, dtype=np.uint64)
        for packed in rows.column("counts").to_pylist():
            part = np.frombuffer(zlib.decompress(packed), dtype="<u4")
            join(total[: len(part)], part, out=total[: len(part)])
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()),
                         "counts": pa.array([zlib.compress(np.minimum(total, 0xFFFFFFFF).astype("<u4").tobytes(), 1)], pa.binary())})

    return run


def collect_sketch(rows: DataFrame, bits: int, how: str = "sum", dtype: type = np.uint32) -> np.ndarray:
    """Join the tasks' sketches ("sum" or "max"); the result has exactly 2^bits counters of ``dtype``, which must hold them."""
    out = np.zeros(1 << bits, dtype=dtype)
    for r in rows.groupBy("chunk").applyInArrow(_merge(how), SCHEMA).collect():
        part = np.frombuffer(zlib.decompress(r["counts"]), dtype="<u4")
        at = r["chunk"] * CHUNK
        out[at : at + CHUNK] = part[: len(out) - at]
    return out


def id_filter(ids: DataFrame, column: str, bits: int = 23) -> Callable[[np.ndarray], np.ndarray]:
    """A membership filter of a long column, of 2^bits bits: false positives, never false negatives."""
    from ledgerline.llm.textscan import mix

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=np.uint8)
        for b in batches:
            v = b.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            counts[bucket(mix(v), bits)] = 1
        yield from to_rows(counts)

    packed = np.packbits(collect_sketch(ids.select(column).mapInArrow(fill, SCHEMA), bits) > 0)
    shared = ids.sparkSession.sparkContext.broadcast(packed)  # 2^bits / 8 bytes

    def test(v: np.ndarray) -> np.ndarray:
        at = bucket(mix(v.astype(np.int64).view(np.uint64)), bits)
        return (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0

    return test


def _any_bit(key: tuple, rows: pa.Table) -> pa.Table:
    total = np.zeros(CHUNK, dtype=np.uint8)
    for packed in rows.column("counts").to_pylist():
        total |= np.frombuffer(zlib.decompress(packed), dtype=np.uint8)
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def bit_filter(ids: DataFrame, column: str, bits: int) -> Callable[[np.ndarray], np.ndarray]:
    """As `id_filter`, over packed bits all the way, for larger filters (2^bits / 8 bytes a task and on the driver)."""
    from ledgerline.llm.textscan import mix

    def at(v: np.ndarray) -> np.ndarray:
        return bucket(mix(v.view(np.uint64)), bits)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for b in batches:
            where = at(b.column(0).drop_null().to_numpy(zero_copy_only=False))
            np.bitwise_or.at(seen, where >> 3, (np.uint8(128) >> (where & 7).astype(np.uint8)))
        for c in range(0, len(seen), CHUNK):
            part = seen[c : c + CHUNK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([c // CHUNK], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                                                 ["chunk", "counts"])

    out = np.zeros(1 << (bits - 3), dtype=np.uint8)
    # one job: a local iterator would run one after another for each partition
    for r in ids.select(column).mapInArrow(fill, SCHEMA).groupBy("chunk").applyInArrow(_any_bit, SCHEMA).collect():
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(r["counts"]), dtype=np.uint8)
    shared = ids.sparkSession.sparkContext.broadcast(out)

    def test(v: np.ndarray) -> np.ndarray:
        where = at(v)
        return (shared.value[where >> 3] >> (7 - (where & 7)).astype(np.uint8)) & 1 > 0

    return test
