r"""Operator 13: phrase collocations by SON partitioning.

The corpus is cut into a few shards.  Each shard is mined completely, level by
level (a phrase is counted only if its sub-phrases were frequent), at a support
lowered to the shard's share of the words: a phrase with ``support``
occurrences reaches the lowered support in one shard at least.  The union of
the locally frequent phrases is then counted over the whole corpus, exactly and
by the phrases' own words, in a second pass.

With an absolute support of s, lowered supports t can prune only while the sum
of (t - 1) stays below s, so there are few shards and each is a distributed
aggregation rather than the memory of one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm import sketch
from ledgerline.llm.tables import drop, settle, spill
from ledgerline.llm.textscan import Words, mix, pieces, shingles, span_hashes, utf8

#: Pieces end at `[.,;:!?\x0A-\x0D]`.
CUT = np.zeros(256, dtype=bool)
CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
#: Words `[^\x20\x09]+` of a piece.
IN_WORD = ~CUT
IN_WORD[[0x20, 0x09]] = False

#: Grams that a task holds before it counts them, and bytes of text that it scans at once.
HELD, SCANNED = 2 << 20, 1 << 20
#: Least and most bits of a filter of frequent phrases (64 MB at most): false positives cost work, never results.
FILTER_BITS = (20, 29)
#: A language is ranked in this many parts first, so that its last ranking sees ``top`` phrases of each.
RANKED_PARTS = 16


class _Scan:
    """Words of a batch with the pieces and languages they stand in."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = utf8(batch.column(batch.schema.get_field_index("text")), lower=True)
        self.words = Words(data, offsets, IN_WORD)
        self.hashes = self.words.hashes()
        self.row = np.repeat(np.arange(len(offsets) - 1), self.words.count)
        piece = np.cumsum(CUT[data])[self.words.start] if len(data) else np.empty(0, dtype=np.int64)
        new = np.flatnonzero((piece[1:] != piece[:-1]) | (self.row[1:] != self.row[:-1])) + 1
        self.first = np.concatenate([[0], new, [len(piece)]]).astype(np.int64) if len(piece) else np.zeros(1, dtype=np.int64)
        coded = batch.column(batch.schema.get_field_index("lang")).dictionary_encode()
        self.langs, self.lang = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        raw, ends = utf8(self.langs)
        self.lang_hash = span_hashes(raw, ends[:-1], ends[1:])

    def keys(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(key of language and words, position) of every phrase of ``k`` words."""
        grams, at = shingles(self.hashes, self.first, k)
        return mix(grams ^ self.lang_hash[self.lang[self.row[at]]]), at


#: Columns of `_mine`: single words, longer phrases.
MINED = ["lang", "shard", "part", "key", "n"], ["part", "key", "n"]


def _mine(k: int, known: Callable[[np.ndarray], np.ndarray] | None):
    """Counts by (part, key) of phrases of ``k`` words whose sub-phrases are ``known``; of single words also by lang and shard.

    ``part`` is a hash of lang and shard, so that the many rows of longer phrases are numbers alone.
    """

    def count(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, shard, code), parts in held.items():
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            for i in range(0, len(keys), 1 << 18):
                some = keys[i : i + (1 << 18)]
                names = [pa.repeat(pa.scalar(lang, pa.string()), len(some)), pa.repeat(pa.scalar(shard, pa.int32()), len(some))]
                yield pa.RecordBatch.from_arrays(
                    [*(names if k == 1 else []), pa.repeat(pa.scalar(code, pa.int64()), len(some)), pa.array(some.view(np.int64)),
                     pa.array(n[i : i + (1 << 18)].astype(np.int64))], MINED[k > 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for b in pieces(batches, limit=SCANNED):
            scan = _Scan(b)
            keys, at = scan.keys(k)
            if known is not None and len(keys):
                sub, where = scan.keys(k - 1)
                ok = np.zeros(len(scan.hashes) + 1, dtype=bool)
                ok[where] = known(sub.view(np.int64))
                both = ok[at] & ok[at + 1]
                keys, at = keys[both], at[both]
            row = scan.row[at]
            shard = b.column(b.schema.get_field_index("shard")).to_numpy(zero_copy_only=False)
            group = scan.lang[row].astype(np.int64) * (int(shard.max()) + 1) + shard[row]
            for g in np.unique(group):
                lang, at_shard = divmod(int(g), int(shard.max()) + 1)
                code = mix(scan.lang_hash[lang : lang + 1] ^ np.uint64(at_shard + 1)).view(np.int64)
                of = (scan.langs[lang].as_py(), at_shard, int(code[0]))
                held.setdefault(of, []).append(keys[group == g])
            size += len(keys)
            if size > HELD:
                yield from count(held)
                held, size = {}, 0
        yield from count(held)

    return run


def _codes(columns: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first of each group of equal rows, and the groups' sizes."""
    if size ** len(columns) < 1 << 63:
        code = np.zeros(len(columns[0]), dtype=np.int64)
        for c in columns:
            code = code * size + c
        _, first, n = np.unique(code, return_index=True, return_counts=True)
    else:  # a very long text: its ids do not fit into one number
        _, first, n = np.unique(np.stack(columns, axis=1), axis=0, return_index=True, return_counts=True)
    return first, n


def _count(filters: list[Callable[[np.ndarray], np.ndarray]]):
    """Exact counts, by the words themselves, of all phrases that ``filters`` (by length) let through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, limit=SCANNED):
            scan = _Scan(b)
            w = scan.words
            if not len(w.start):
                continue
            ends = np.concatenate([[0], np.cumsum(w.end - w.start)]).astype(np.int32)
            text = pa.StringArray.from_buffers(len(w.start), pa.py_buffer(ends), pa.py_buffer(w.data[IN_WORD[w.data]].tobytes()))
            coded = text.dictionary_encode()
            ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            size = max(len(coded.dictionary), len(scan.langs))
            for k, wanted in enumerate(filters, 1):
                keys, at = scan.keys(k)
                at = at[wanted(keys.view(np.int64))]
                if not len(at):
                    continue
                first, n = _codes([scan.lang[scan.row[at]].astype(np.int64), *[ids[at + j] for j in range(k)]], size)
                at = at[first]
                words = [coded.dictionary.take(pa.array(ids[at + j])) for j in range(k)]
                phrase = pc.binary_join_element_wise(*words, " ") if k > 1 else words[0]
                lang = scan.langs.take(pa.array(scan.lang[scan.row[at]]))
                out = pa.RecordBatch.from_arrays([lang, phrase, pa.array(np.full(len(at), k, dtype=np.int32)), pa.array(n.astype(np.int64))],
                                                 ["lang", "phrase", "k", "n"])
                for i in range(0, len(at), 1 << 16):
                    yield out.slice(i, 1 << 16)

    return run


def frequent_phrases(docs: DataFrame, support: int = 10, longest: int = 3, shards: int = 3,
                     text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): exact counts (lang, phrase, k, n) of all phrases of up to ``longest`` words with
    ``support`` occurrences or more in their language, and (lang, n): the words of each language.

    Occurrences overlap and never cross a piece.  Null texts are empty, a null
    language is ``und``; a language with other languages' phrases has counts of
    its own.  Every row counts, repeated rows too; other columns are ignored.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("lang", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int").alias("shard"), "text")
    filters: list[Callable[[np.ndarray], np.ndarray]] = []
    least = totals = None
    for k in range(1, longest + 1):
        names = "lang string, shard int, " if k == 1 else ""
        mined = rows.mapInArrow(_mine(k, filters[-1] if filters else None), names + "part long, key long, n long")
        local = mined.groupBy(*MINED[k > 1][:-1]).agg(F.sum("n").alias("n"))
        if least is None:  # the counts of single words give the shards' shares
            local = spill(local, "phrases-words")
            shares = spill(local.groupBy("lang", "shard", "part").agg(F.sum("n").alias("words")), "phrases-shares")
            totals = shares.groupBy("lang").agg(F.sum("words").alias("n"))
            # ceil(support * words / n): if no shard reaches its own, the sum stays below support
            ceiling = F.expr(f"(cast({support} as decimal(10,0)) * cast(words as decimal(19,0)) + n - 1) div n")
            least = shares.join(totals, "lang").groupBy("part").agg(F.min(ceiling).alias("least"))
            least = spill(least, "phrases-least")
        found = spill(local.join(least, "part").where("n >= least").select("key"), "phrases-local")
        bits = (16 * found.count()).bit_length()  # 16 bits a key or more, up to the bound
        filters.append(sketch.bit_filter(found, "key", min(max(bits, FILTER_BITS[0]), FILTER_BITS[1])))
        drop(found, local)
        del local, found, mined
        settle(docs.sparkSession)
    counted = rows.mapInArrow(_count(filters), "lang string, phrase string, k int, n long")
    counted = counted.groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n")).where(F.col("n") >= support)
    counted = spill(counted, "phrases-frequent")
    settle(docs.sparkSession)
    return counted, totals


def score_collocations(phrases: DataFrame, inside_percent: int = 50) -> DataFrame:
    """lang, phrase, k, a, l, r, score of every phrase of two words or more that no longer one covers.

    Each cut into a first part (l occurrences) and the rest (r) scores
    floor(1000000 * a * a / (l * r)); the lowest cut counts, of equal ones the
    one with the fewest words before it.  A phrase goes if a longer frequent
    phrase that holds its words in a row has ``inside_percent`` or more of its
    occurrences.  The arithmetic is in whole numbers of 38 digits.
    """
    part = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("of"))
    whole = phrases.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = whole.select("lang", "phrase", "k", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "k", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("head"),
                       F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("rest"))
    cuts = (cuts.join(part.select("lang", F.col("part").alias("head"), F.col("of").alias("l")), ["lang", "head"])
            .join(part.select("lang", F.col("part").alias("rest"), F.col("of").alias("r")), ["lang", "rest"]))
    cuts = cuts.withColumn("score", F.expr(
        "cast((cast(1000000 * cast(a as decimal(16,0)) as decimal(22,0)) * cast(a as decimal(16,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as bigint)"))
    scored = cuts.groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    scored = scored.select("lang", "phrase", "k", "a", "best.l", "best.r", "best.score")
    longer = whole.where("k > 2").select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("m"))
    longer = longer.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)).alias("at"))
    longer = (longer.groupBy("lang", F.array_join(F.slice("w", F.col("at"), F.col("m")), " ").alias("phrase"))
              .agg(F.max("a").alias("most")))
    left = scored.join(longer, ["lang", "phrase"], "left")
    covered = F.coalesce(100 * F.col("most") >= inside_percent * F.col("a"), F.lit(False))
    return left.where(~covered).drop("most")


def mine_collocations(docs: DataFrame, support: int = 10, longest: int = 3, top: int = 2000, shards: int = 3,
                      text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, k, a, l, r, n, score.

    Ordered by score, then a, both descending, then the phrase in UTF-8 byte
    order.  No documents, or none with a frequent phrase: no rows.
    """
    phrases, totals = frequent_phrases(docs, support, longest, shards, text_col, lang_col)
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS)).alias("_part")
    scored = score_collocations(phrases).select("*", part)
    near = scored.withColumn("_rank", F.row_number().over(W.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "k", "a", "l", "r", "n", "score")
