"""Operator 12: license scans with ordered signature rules (DataFrame functions only).

Hundreds of signatures (`license_rules`) are gated by a keyword prefilter: a
document runs only those whose keyword is among its words.  A detection goes if
another one of a better tier, or of its own tier and no shorter, holds its
interval; of equal intervals in one tier the first signature stays.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.license_rules import CONFIDENCE, Signature, signatures

#: What separates words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of text with A-Z in lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Marks around a match; no word holds them.
OPEN, CLOSE = "\x01", "\x02"
_HIT = "struct<start:int,back:int,tier:int,no:int>"
#: Detections that one step of the suppression appends at a time (keeps appending linear).
BLOCK = 256


def _none() -> Column:
    return F.array().cast(f"array<{_HIT}>")


def _found(padded: Column, rule: Column) -> Column:
    """Intervals of one signature: struct(start, back, tier, no), ``back`` being minus the last word's place."""
    marked = F.regexp_replace(padded, rule["regex"], F.lit(f" {OPEN}$1{CLOSE} "))
    words = F.split(F.trim(marked), " +")
    at = lambda mark, edge: F.filter(
        F.transform(words, lambda w, i: F.when(edge(w, F.lit(mark)), i)), lambda i: i.isNotNull())
    both = F.arrays_zip(at(OPEN, F.startswith).alias("s"), at(CLOSE, F.endswith).alias("e"))
    hits = F.transform(both, lambda x: F.struct(x["s"].alias("start"), (-x["e"]).alias("back"), rule["tier"].alias("tier"), rule["no"].alias("no")))
    return F.when(F.instr(marked, OPEN) > 0, hits).otherwise(_none())


def _suppress(hits: Column, tiers: int) -> Column:
    """The detections that stay, of detections sorted by (start, longest first, tier, order).

    Whatever holds an interval comes before it, so the furthest end of each
    tier so far decides; that is all the state there is.
    """
    empty = _none()

    def step(state: Column, hit: Column) -> Column:
        held = F.exists(F.slice(state["ends"], F.lit(1), hit["tier"] + 1), lambda e: e >= -hit["back"])
        ends = F.transform(state["ends"], lambda e, i: F.when(i == hit["tier"], F.greatest(e, -hit["back"])).otherwise(e))
        return F.struct(ends.alias("ends"), F.when(held, state["kept"]).otherwise(F.concat(state["kept"], F.array(hit))).alias("kept"))

    def block(state: Column, part: Column) -> Column:
        after = F.aggregate(part, F.struct(state["ends"].alias("ends"), empty.alias("kept")), step)
        return F.struct(after["ends"].alias("ends"), F.concat(state["blocks"], F.array(after["kept"])).alias("blocks"))

    blocks = F.transform(F.sequence(F.lit(1), F.greatest(F.size(hits), F.lit(1)), F.lit(BLOCK)), lambda i: F.slice(hits, i, BLOCK))
    start = F.struct(F.array(*[F.lit(-1)] * tiers).alias("ends"), F.array().cast(f"array<array<{_HIT}>>").alias("blocks"))
    return F.aggregate(blocks, start, block, lambda s: F.flatten(s["blocks"]))


def scan_licenses(docs: DataFrame, rules: Sequence[Signature] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    Words are counted from 0.  Base phrases count wherever their words stand in
    a row, whatever suppresses them; their labels always stay.  ``detections``
    are the ones that stay, in order: label, first and last word, tier, and the
    words themselves.  ``score`` is the confidence of the surest detection (0
    without any).

    Null and empty texts have no words.  Each row is scanned, repeated rows
    too; an empty table gives no rows; other columns are not looked at.
    """
    rules = signatures() if rules is None else tuple(rules)
    listed = F.array(*[F.struct(F.array(*[F.lit(k) for k in r.keyword.split("|")]).alias("keywords"), F.lit(r.regex).alias("regex"),
                                F.lit(r.tier).alias("tier"), F.lit(n).alias("no")) for n, r in enumerate(rules)])
    keywords = sorted({k for r in rules for k in r.keyword.split("|")})
    names, trust = F.array(*[F.lit(r.label) for r in rules]), F.array(*[F.lit(c) for c in CONFIDENCE])
    label = lambda hit: F.element_at(names, hit["no"] + 1)
    sure = lambda hit: F.element_at(trust, hit["tier"] + 1)
    base = [n for n, r in enumerate(rules) if r.base]

    lower = F.translate(F.coalesce(F.col(text_col), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    df = docs.select(F.col(id_col), F.array_remove(F.split(lower, BETWEEN), "").alias("_words"))
    df = df.withColumn("_present", F.array_intersect("_words", F.array(*[F.lit(k) for k in keywords])))
    padded = F.concat(F.lit(" "), F.array_join("_words", "  "), F.lit(" "))
    asked = F.filter(listed, lambda r: F.arrays_overlap(r["keywords"], F.col("_present")))
    hits = F.array_sort(F.flatten(F.transform(asked, lambda r: _found(F.col("_padded"), r))))
    df = df.withColumn("_padded", F.when(F.size("_present") > 0, padded))
    df = df.withColumn("_hits", F.when(F.size("_present") > 0, hits).otherwise(_none()))
    df = df.withColumn("_base", F.filter("_hits", lambda h: h["no"].isin(base)))
    df = df.withColumn("_kept", F.when(F.size("_hits") > 0, _suppress(F.col("_hits"), len(CONFIDENCE))).otherwise(F.col("_hits")))
    of_base = F.array_distinct(F.transform("_base", label))
    every = F.array_union(of_base, F.transform("_kept", label))
    place = lambda of: of(F.transform("_base", lambda h: h["start"].cast("long")))
    detections = F.transform("_kept", lambda h: F.struct(
        label(h).alias("label"), h["start"].alias("first_word"), (-h["back"]).alias("last_word"), h["tier"].alias("tier"),
        F.array_join(F.slice("_words", h["start"] + 1, 1 - h["back"] - h["start"]), " ").alias("words")))
    return df.select(
        id_col, F.size("_words").cast("long").alias("n_words"), F.size("_base").cast("long").alias("n_base"),
        place(F.array_min).alias("first_word"), place(F.array_max).alias("last_word"),
        F.array_join(F.array_sort(of_base), ",").alias("base_labels"), F.array_join(F.array_sort(every), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("_kept", sure)), F.lit(0.0)).alias("score"), detections.alias("detections"))
