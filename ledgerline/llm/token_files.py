"""Operator 5: token-id files of compressed, independently decodable blocks.

File: magic ``LTOK0001``; then blocks; a block is a header (magic, ids, document
pieces, bytes of the coded ids, CRC-32 of the piece table), the piece table
(doc id, ids, flags) and the coded ids (`range_coder`, with its own CRC-32).  A
document may run over several blocks; flags mark its first and last piece and a
null id.  A block needs nothing from other blocks.  Files follow the order of
doc_id or of the caller's columns, so do documents inside a file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import range_coder
from ledgerline.llm.shared_files import reading, writing
from ledgerline.llm.textscan import pieces
from ledgerline.llm.token_ids import PieceEncoder
from ledgerline.session import fresh_dir

MAGIC = b"LTOK0001"
_BLOCK = struct.Struct("<4sIIII")
_BLOCK_MAGIC = b"LBLK"
_PIECE = np.dtype([("doc", "<i8"), ("n", "<u4"), ("flags", "<u4")])
FIRST, LAST, NULL_ID = 1, 2, 4

#: Ids of GPT-2's byte-level vocabulary; a parameter of the file's coder.
VOCABULARY = 50257
FILE_SCHEMA = "part int, path string, n_docs long, n_ids long"
DOC_SCHEMA = "part int, ordinal long, doc_id long, start_in_file long, n_tokens long, ids_crc32 long"

_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    """This worker's encoder; its piece cache lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


class BlockWriter:
    """Gathers documents' ids and writes full blocks."""

    def __init__(self, out, vocabulary: int, block_ids: int):
        self.out, self.vocabulary, self.block_ids = out, vocabulary, block_ids
        self.ids = np.empty(0, dtype=np.uint32)  # grows to a block's ids, then serves all blocks
        self.table: list[tuple[int, int, int]] = []
        self.held = 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        flags, doc, at = FIRST | (NULL_ID if doc_id is None else 0), doc_id or 0, 0
        while True:
            take = min(len(ids) - at, self.block_ids - self.held)
            last = at + take == len(ids)
            self.table.append((doc, take, flags | (LAST if last else 0)))
            if self.held + take > len(self.ids):
                grown = np.empty(min(self.block_ids, max(1 << 16, 2 * (self.held + take))), dtype=np.uint32)
                grown[: self.held] = self.ids[: self.held]
                self.ids = grown
            self.ids[self.held : self.held + take] = ids[at : at + take]
            self.held += take
            at += take
            flags &= ~FIRST
            if self.held == self.block_ids:
                self.flush()
            if last:
                return

    def flush(self) -> None:
        if not self.held:
            return
        coded = range_coder.encode_block(self.ids[: self.held], self.vocabulary)
        table = np.array(self.table, dtype=_PIECE).tobytes()
        self.out.write(_BLOCK.pack(_BLOCK_MAGIC, self.held, len(self.table), len(coded), zlib.crc32(table)))
        self.out.write(table)
        self.out.write(coded)
        self.table, self.held = [], 0


def read_blocks(source) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(piece table, ids) of each block of an open file; damage raises ValueError."""
    if source.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    while head := source.read(_BLOCK.size):
        magic, n, rows, size, check = _BLOCK.unpack(head)
        table = source.read(rows * _PIECE.itemsize)
        if magic != _BLOCK_MAGIC or zlib.crc32(table) != check:
            raise ValueError("damaged block header")
        ids = range_coder.decode_block(source.read(size))
        if len(ids) != n:
            raise ValueError("block length differs")
        yield np.frombuffer(table, dtype=_PIECE), ids


def _write(root: str, tokenizer: str, vocabulary: int, end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(tokenizer), np.array([end_id], dtype=np.uint32)
        part = TaskContext.get().partitionId()
        path, docs, total = f"{root}/part-{part:06d}.tok", 0, 0
        with writing(path) as out:
            blocks = BlockWriter(out, vocabulary, block_ids)
            for b in pieces(batches):
                ids, bounds = encoder.encode(b.column(1))
                for i, doc_id in enumerate(b.column(0).to_pylist()):
                    doc = np.concatenate([ids[bounds[i] : bounds[i + 1]], end])
                    blocks.add(doc_id, doc)
                    docs += 1
                    total += len(doc)
            blocks.flush()
        if docs:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([path]), pa.array([docs], pa.int64()), pa.array([total], pa.int64())],
                ["part", "path", "n_docs", "n_ids"])

    return run


def write_token_files(docs: DataFrame, tokenizer: str, vocabulary: int = VOCABULARY, end_id: int = 0,
                      block_ids: int = range_coder.BLOCK_IDS, id_col: str = "doc_id", text_col: str = "text",
                      order_cols: tuple[str, ...] = ()) -> list[tuple]:
    """Encode every whole text, ``end_id`` after each, into files in ascending id order, or first by ``order_cols``.

    Returns (part, path, documents, ids) of each file, in order; one row per
    task, however many documents.  Null texts are empty; null ids come first;
    rows with equal ids are ordered by their text, so reruns write the same
    files.  No documents: no files.
    """
    spark = docs.sparkSession
    root = fresh_dir(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)])
    keys = [*[F.col(f"_o{i}").asc_nulls_first() for i in range(len(order_cols))], F.col("doc_id").asc_nulls_first()]
    # the text's hash decides ties without making the text a sort key
    rows = (rows.withColumn("_h", F.xxhash64("text")).repartitionByRange(*keys)
            .sortWithinPartitions(*keys, "_h").select("doc_id", "text"))
    files = rows.mapInArrow(_write(root, tokenizer, vocabulary, end_id, block_ids), FILE_SCHEMA)
    return sorted(tuple(r) for r in files.collect())


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ordinal, start, n, crc = 0, 0, 0, 0
            with reading(path) as source:
                for table, ids in read_blocks(source):
                    raw, at = memoryview(ids.astype("<u4", copy=False)).cast("B"), 0
                    out: list[list] = [[], [], [], [], []]
                    for doc, size, flags in table.tolist():
                        if flags & FIRST:
                            n, crc = 0, 0
                        crc = zlib.crc32(raw[4 * at : 4 * (at + size)], crc)
                        n, at = n + size, at + size
                        if flags & LAST:
                            for column, v in zip(out, (ordinal, None if flags & NULL_ID else doc, start, n, crc), strict=True):
                                column.append(v)
                            ordinal, start = ordinal + 1, start + n
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * len(out[0]), pa.int32()), *[pa.array(c, pa.int64()) for c in out]],
                        ["part", "ordinal", "doc_id", "start_in_file", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, files: list[tuple]) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32.

    Files are decoded as streams, a block at a time, one file per task;
    ``start`` counts the ids of all documents before, in file order.
    """
    before, rows = 0, []
    for part, path, _, ids in files:
        rows.append((part, path, before))
        before += ids
    if not rows:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long, part int")
    listed = spark.createDataFrame(rows, "part int, path string, before long")
    spread = listed.select("part", "path").repartitionByRange(len(rows), "part")
    return (spread.mapInArrow(_read, DOC_SCHEMA).join(F.broadcast(listed.select("part", "before")), "part")  # a row per file
            .select("doc_id", (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32", "part"))


def token_table(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write ``docs`` to token files and read every document back."""
    return read_token_files(docs.sparkSession, write_token_files(docs, tokenizer, **options))
