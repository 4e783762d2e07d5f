"""Operators 3 and 5: exact round trips, damage, awkward rows."""
import hashlib
import io
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import range_coder, token_files, warc
from ledgerline.llm.token_ids import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [1, 2, 127, 128, 1000, 70_000])
def test_range_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (np.zeros(n), rng.integers(0, 50257, n), rng.choice([0, 50256], n), np.arange(n) % 50257, rng.zipf(1.3, n) % 50257):
        ids = ids.astype(np.uint32)
        assert (range_coder.decode_block(range_coder.encode_block(ids, 50257)) == ids).all()


def test_range_coder_compresses_and_detects_damage():
    ids = np.tile(np.arange(500, dtype=np.uint32), 100)
    block = range_coder.encode_block(ids, 50257)
    assert len(block) < len(ids)  # a quarter of the raw size
    for i in (0, 9, 30, len(block) // 2, len(block) - 1):
        broken = bytearray(block)
        broken[i] ^= 0x55
        with pytest.raises(ValueError):
            range_coder.decode_block(bytes(broken))
    with pytest.raises(ValueError):
        range_coder.decode_block(block[:-4])


def test_pieces_equal_whole_texts():
    encoder, rnd = PieceEncoder(PATH), random.Random(3)
    parts = ["a", "B", " ", "  ", "\n", "\n\n", "\t", ".", ",", "'s", "'", "é", "É", "1", "23", "\xa0", "　", " ", "\x85",
             "<|endoftext|>", "!!", "$", "中", "😀", "\r\n", "\x1c", "_", "-", "’", "«", " word", "Word,"]
    for _ in range(40):
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 16))) for _ in range(60)] + [None, ""]
        ids, bounds = encoder.encode(pa.array(texts, pa.string()))
        for i, whole in enumerate(encoder.encode_whole([t or "" for t in texts])):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == whole.tolist(), texts[i]


def test_piece_cache_may_overflow(monkeypatch):
    from ledgerline.llm import token_ids
    monkeypatch.setattr(token_ids, "MAX_PIECES", 3)
    encoder = PieceEncoder(PATH)
    for t in ("one two three four five", "six seven one", "two nine ten"):
        ids, _ = encoder.encode(pa.array([t]))
        assert ids.tolist() == encoder.encode_whole([t])[0].tolist()


def brute_tokens(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_token_files_round_trip(spark):
    rnd = random.Random(1)
    rows = [(i * 3 - 20, " ".join(rnd.choice(["the", "Übung", "x!!", "\n"]) for _ in range(rnd.randint(0, 300)))) for i in range(40)]
    rows += [(500, None), (501, ""), (502, "same"), (502, "same"), (None, "no id")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, start int, part string").repartition(5)
    want = brute_tokens(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    for block in (1 << 22, 1000, 7):  # documents within a block and over many
        got = token_files.token_table(df, PATH, block_ids=block).drop("part")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_token_files_are_ordered_and_rerun_alike(spark):
    df = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "doc_id long, text string").repartition(7)
    runs = [token_files.write_token_files(df, PATH) for _ in range(2)]
    raw = [[open(f[1].removeprefix("file:"), "rb").read() for f in run] for run in runs]
    assert raw[0] == raw[1]
    seen = [t["doc"] for run in raw[:1] for f in run for t, _ in token_files.read_blocks(io.BytesIO(f))]
    assert np.concatenate(seen).tolist() == list(range(50))


def test_no_documents(spark):
    assert token_files.token_table(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def brute_pages(rows):
    groups = {}
    for n, (i, _, h) in enumerate(rows):
        groups.setdefault((h or "").encode(), []).append((i is not None, i or 0, n))
    out = []
    for n, (i, u, h) in enumerate(rows):
        b = (h or "").encode()
        best = max(groups[b])
        revisit = len(b) >= 1000 and best[2] != n
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", best[1] if revisit and best[0] else None, u))
    return sorted(out, key=str)


def test_archives_round_trip(spark):
    big = "é" * 100_000
    rows = [(1, "http://a/%0A", None), (2, None, ""), (3, "u\r\nv", "x" * 999), (4, "u", "x" * 999), (5, "u", "y" * 1000), (9, "u", "y" * 1000),
            (9, "u", "y" * 1000), (7, "w", big), (6, "w", big), (None, "n", big), (8, "z", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"), (8, "z", "\r\n\r\n")]
    df = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, payload_digest string, record int").coalesce(1)
    for size in (64 << 10, 1000, 7777):
        chunks = warc.chunk_table(df, chunk_bytes=size)
        files = warc.write_archives(chunks, warc.decide_revisits(chunks))
        assert sum(f[2] for f in files) == len(rows)
        got = sorted(map(tuple, warc.read_archives(spark, files).collect()), key=str)
        assert got == brute_pages(rows)


def test_chunks_carry_running_digests(spark):
    df = spark.createDataFrame([(1, "u", "abcdefghij")], "page_id long, url string, html string")
    rows = sorted(warc.chunk_table(df, chunk_bytes=4).collect(), key=lambda r: r.chunk)
    assert [bytes(r.data) for r in rows] == [b"abcd", b"efgh", b"ij"] and [r.last for r in rows] == [False, False, True]
    assert [r.digest_so_far for r in rows] == [hashlib.sha1(b"abcdefghij"[:n]).hexdigest() for n in (4, 8, 10)]


def test_damaged_archive_is_noticed():
    payload = b"p" * 5000
    head, http = warc._header("response", 1, "u", len(payload), hashlib.sha1(payload).hexdigest(), None)
    good = zlib.compressobj(1, zlib.DEFLATED, 31)
    record = good.compress(head + http + payload + b"\r\n\r\n") + good.flush()
    assert [r[:2] for r in warc.read_records(io.BytesIO(record * 3))] == [(1, 5000)] * 3
    bad = zlib.compressobj(1, zlib.DEFLATED, 31)
    other = bad.compress(head + http + b"q" * 5000 + b"\r\n\r\n") + bad.flush()
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(other)))
    with pytest.raises((ValueError, zlib.error)):
        list(warc.read_records(io.BytesIO(record[:-60])))


def test_no_pages(spark):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_pieces_with_bytes_that_may_begin_white_space():
    """Quotation marks, kana and separators beside real white space of more bytes than one."""
    import public_tokenizers
    import pyarrow as pa
    from ledgerline.llm.token_ids import PieceEncoder
    encoder = PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["it\u2019s \u201cso\u201d \u3042\u3044 \u00a9x", "a\x1cb \x1f c\x1d", "\x1c", " \u00a0", "one\u2003two \u3000 \u00a0x", "\u00c2 \u00e1\u00e2", " ", ""]
    ids, bounds = encoder.encode(pa.array(texts))
    for i, whole in enumerate(encoder.encode_whole(texts)):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == whole.tolist(), texts[i]
