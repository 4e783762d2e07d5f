"""Operator 10: benchmark decontamination as a prefix-filtered set join.

A benchmark item is cut into windows of consecutive words.  A document holds a
window only if it holds all its shingles, so one necessary prefix token per
window is enough: the shingle that is rarest in the corpus.  Documents are
probed for those tokens alone; a hit fixes where the window would have to lie
(positional bound), whether it fits into the text (length bound), and the words
around the hit decide the containment exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import sketch
from ledgerline.llm.tables import spill
from ledgerline.llm.textscan import ALNUM, Words, list_column, pieces, shingles, utf8

#: Words of a shingle; shorter windows are one shingle of their own length.
SHINGLE = 5
#: Bits of the broadcast token filter (2 MB); false positives only cost probes.
FILTER_BITS = 24

WINDOW_SCHEMA = "item_id string, words string, size int, tokens array<long>"


def _windows(size: int):
    """Windows of each item, with the hash of each of their shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            data, offsets = utf8(b.column(1), lower=True)
            words = Words(data, offsets, ALNUM)
            hashes = words.hashes()
            by_size = {k: dict(zip(*reversed([x.tolist() for x in shingles(hashes, words.first, k)]), strict=True)) for k in range(1, SHINGLE + 1)}
            ids = b.column(0).to_pylist()
            out: dict[str, list] = {"item_id": [], "words": [], "size": [], "tokens": []}
            for i, n in enumerate(words.count.tolist()):
                if not n:
                    continue
                at, width = int(words.first[i]), min(size, n)
                text = words.words(at, at + n)
                k = min(SHINGLE, width)
                for j in range(n - width + 1):
                    out["item_id"].append(ids[i])
                    out["words"].append(" ".join(text[j : j + width]))
                    out["size"].append(width)
                    out["tokens"].append(np.array([by_size[k][at + j + o] for o in range(width - k + 1)], dtype=np.uint64).view(np.int64))
            if out["words"]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["item_id"], pa.string()), pa.array(out["words"], pa.string()), pa.array(out["size"], pa.int32()),
                     pa.array(out["tokens"], pa.list_(pa.int64()))], ["item_id", "words", "size", "tokens"])

    return run


def _count(wanted, sizes: list[int]):
    """Occurrences of the wanted shingles, summed per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            data, offsets = utf8(b.column(0), lower=True)
            words = Words(data, offsets, ALNUM)
            hashes = words.hashes()
            for k in sizes:
                grams, _ = shingles(hashes, words.first, k)
                tokens, counts = np.unique(grams[wanted(grams.view(np.int64))], return_counts=True)
                if len(tokens):
                    yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts.astype(np.int64))], ["token", "n"])

    return run


PROBE_SCHEMA = "doc_id long, k1 long, k2 long, n_words long, token array<long>, at array<long>, lead array<int>, context array<string>"


def _probe(wanted, sizes: list[int], size: int):
    """Per document: word count and, for each probed token, the words that a window over it could span."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            data, offsets = utf8(b.column(1), lower=True)
            words = Words(data, offsets, ALNUM)
            hashes = words.hashes()
            found = []
            for k in sizes:
                grams, at = shingles(hashes, words.first, k)
                hit = wanted(grams.view(np.int64))
                found.append((grams[hit], at[hit]))
            grams, at = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))
            order = np.argsort(at, kind="stable")
            grams, at = grams[order], at[order]
            doc = np.searchsorted(words.first, at, side="right") - 1
            low = np.maximum(words.first[doc], at - (size - 1))
            high = np.minimum(words.first[doc + 1], at + size)
            context = [" ".join(words.words(a, z)) for a, z in zip(low.tolist(), high.tolist(), strict=True)]
            bounds = np.searchsorted(doc, np.arange(b.num_rows + 1))
            lists = pa.array(bounds.astype(np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), pa.array(words.count.astype(np.int64)),
                 list_column(grams.view(np.int64), bounds, pa.int64()), list_column(at - words.first[doc], bounds, pa.int64()),
                 list_column((at - low).astype(np.int32), bounds, pa.int32()), pa.ListArray.from_arrays(lists, pa.array(context, pa.string()))],
                ["doc_id", "k1", "k2", "n_words", "token", "at", "lead", "context"])

    return run


def row_key(doc_id, text) -> list:
    """Columns k1, k2: 128 bits that tell rows apart by id and text."""
    return [F.xxhash64(doc_id, text).alias("k1"), F.xxhash64(text, F.lit(1), doc_id).alias("k2")]


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: n_words, n_hit, spans, items, contaminated, and its `row_key`.

    ``spans`` are the hit word ranges (start, end), overlapping ones merged;
    ``items`` the ids (strings, sorted) of items with an occurring window.
    Items shorter than ``size`` words are one window; items without words have
    none.  Null or word-less documents have no hits.  A null item id marks
    words but is not listed.  Repeated rows get equal results each; repeated
    items and windows are matched once.  Other columns are ignored; an empty
    benchmark leaves every document clean.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *row_key(F.col(id_col).cast("long"), F.col(text_col)))
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).alias("text"))
    cut = spill(items.mapInArrow(_windows(size), WINDOW_SCHEMA), "bench-windows")
    windows = spill(cut.groupBy("words").agg(F.first("size").alias("size"), F.first("tokens").alias("tokens")), "bench-distinct")
    owners = cut.where("item_id is not null").select("words", "item_id").distinct()
    offered = windows.select("words", "size", F.posexplode("tokens").alias("offset", "token"))
    sizes = sorted({min(SHINGLE, r["size"]) for r in windows.select("size").distinct().collect()})  # at most `size` values
    wanted = sketch.id_filter(offered, "token", FILTER_BITS)
    seen = docs.select("text").mapInArrow(_count(wanted, sizes), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    # the rarest shingle of a window is its prefix; one that never occurs rules the window out
    index = (offered.join(seen, "token", "left").groupBy("words", "size")
             .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("p"))
             .where("p.n > 0").select("words", "size", "p.token", "p.offset"))
    index = spill(index, "bench-prefixes")
    probe = sketch.id_filter(index, "token", FILTER_BITS)
    probed = spill(docs.mapInArrow(_probe(probe, sizes, size), PROBE_SCHEMA), "bench-probes")
    hits = probed.select("k1", "k2", F.explode(F.arrays_zip("token", "at", "lead", "context")).alias("h")).select("k1", "k2", "h.*")
    span = F.when(F.col("lead") >= F.col("offset"),
                  F.array_join(F.slice(F.split("context", " "), F.greatest(F.col("lead") - F.col("offset"), F.lit(0)) + 1, F.col("size")), " "))
    held = (hits.join(index, "token").where(span == F.col("words"))
            .select("k1", "k2", "words", (F.col("at") - F.col("offset")).alias("start"), (F.col("at") - F.col("offset") + F.col("size")).alias("end")))
    held = spill(held, "bench-hits")
    merged = F.aggregate(
        "ranges", F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda a, r: F.when((F.size(a) > 0) & (F.coalesce(F.get(a, F.size(a) - 1)["end"], F.lit(-1)) >= r["start"]),
                            F.concat(F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))),
                                     F.array(F.struct(F.get(a, F.size(a) - 1)["start"].alias("start"), F.greatest(F.get(a, F.size(a) - 1)["end"], r["end"]).alias("end")))))
        .otherwise(F.concat(a, F.array(F.struct(r["start"].cast("long").alias("start"), r["end"].cast("long").alias("end"))))))
    spans = (held.groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("ranges"))
             .select("k1", "k2", merged.alias("spans")))
    named = (held.select("k1", "k2", "words").distinct().join(owners, "words").groupBy("k1", "k2")
             .agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    found = spill(spans.join(named, ["k1", "k2"], "left"), "bench-found")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return (probed.select("doc_id", "k1", "k2", "n_words").join(found, ["k1", "k2"], "left")
            .select("doc_id", "n_words", F.coalesce(hit, F.lit(0)).cast("long").alias("n_hit"), F.coalesce("spans", F.array()).alias("spans"),
                    F.coalesce("items", F.array()).alias("items"), F.col("spans").isNotNull().alias("contaminated"), "k1", "k2"))
