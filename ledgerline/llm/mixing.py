"""Operator 7: mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1].  Its token
demand up to t is its target times the normalised integral of the schedule;
a document's position is the time at which the demand reaches the tokens that
come before it in its source's order.  Sorting by position interleaves the
sources as their schedules ask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.llm.tables import spill

#: Words of a text, as the pattern of the size.
WORD = r"[^\x20\x09-\x0D]+"


def text_size(text: Column) -> Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights in code-point order of the source (null last), repeating ``cycle``."""
    n = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(w) for w in cycle])
    return sources.withColumn("weight", F.get(weights, F.pmod(n, F.lit(len(cycle)))).cast("long"))


def fill_targets(weighted: DataFrame, max_epochs: int = 3) -> DataFrame:
    """Add ``target``: the total shared by weight, no source above ``max_epochs`` times its size.

    The level L with sum(min(max_epochs * size, L * weight)) = total is unique.
    In order of size per weight the full sources come first, so it follows from
    running sums.  A source without words has target 0.
    """
    order = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy()
    cap = (max_epochs * F.col("source_size"))
    df = (weighted
          .withColumn("_total", F.sum("source_size").over(whole))
          .withColumn("_full", F.coalesce(F.sum(cap).over(before), F.lit(0)))
          .withColumn("_rest", F.sum("weight").over(rest))
          .withColumn("_open", (F.col("_total") - F.col("_full")) * F.col("weight") <= cap * F.col("_rest")))
    # the first open source fixes the level of all after it
    level = F.min(F.when(F.col("_open"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"),
                                                  (F.col("_total") - F.col("_full")).alias("n"), F.col("_rest").alias("d")))).over(whole)
    df = df.withColumn("_level", level)
    share = (F.col("_level.n") * F.col("weight")).cast("double") / F.col("_level.d").cast("double")
    return (df.withColumn("target", F.least(share, cap.cast("double")))
            .drop("_total", "_full", "_rest", "_open", "_level"))


def position_of(share: Column, early: Column) -> Column:
    """Time at which a linear schedule has spent ``share`` of its integral.

    The weight runs from ``early`` to ``2 - early`` times its mean, so the
    integral is early*t + (1 - early)*t^2; the inverse is in the stable form
    that has no cancellation.
    """
    root = F.sqrt(early * early + 4 * (1 - early) * share)
    return F.when(share <= 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), 2 * share / (early + root)))


def mix_sources(docs: DataFrame, max_epochs: int = 3, cycle: tuple[int, ...] = (1, 2, 3),
                early: tuple[float, ...] = (1.5, 1.0, 0.5), keep: list[str] | None = None) -> DataFrame:
    """One row per document with its copies in the mix and their positions.

    ``docs`` needs doc_id, text, source; other columns named in ``keep`` go
    along.  Added: size, source_size, weight, target, copies (whole passes over
    the document), taken (= copies * size) and positions (one per copy,
    ascending).  ``early`` gives the schedule of each weight class: its first
    weight over its mean; it must lie in (0, 2).

    A source's documents are ordered by the MD5 of the id, then id, then the
    MD5 of the text, so reruns agree; rows that repeat entirely are
    interchangeable.  The last, partial pass takes the documents whose middle
    lies within the rest, so a source's taken words miss its target by half a
    document at most.  Null text or no words: size 0, no copies.  An empty
    table gives no rows.

    The running sum inside a source, which may hold a third of all rows, is
    split: sums per (source, hash bucket) first, then inside each bucket.  The
    number of buckets follows the row count and does not change the result.
    """
    keep = keep or []
    sized = docs.select("doc_id", "source", *keep, text_size(F.col("text")).alias("size"),
                        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_h"),
                        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("_t"))
    sized = spill(sized, "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = spill(fill_targets(cyclic_weights(sources, cycle), max_epochs), "mix-targets")
    rows = sized.count()
    digits = 1
    while 16 ** digits * 2000 < rows:
        digits += 1
    sized = sized.withColumn("_b", F.substring("_h", 1, digits)).withColumn("_s", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    buckets = sized.groupBy("_s", "_b").agg(F.sum("size").alias("n"))
    across = W.partitionBy("_s").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    buckets = buckets.select("_s", "_b", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("_base"))
    inside = W.partitionBy("_s", "_b").orderBy("_h", "doc_id", "_t").rowsBetween(W.unboundedPreceding, -1)
    placed = (sized.withColumn("_inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(buckets, ["_s", "_b"])
              .join(sources.withColumn("_s", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))).drop("source"), "_s")
              .withColumn("_before", F.col("_base") + F.col("_inner")))
    size, whole = F.col("size"), F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    rest = F.col("target") - whole * F.col("source_size")
    copies = F.when(size > 0, F.least(F.lit(max_epochs).cast("long"), whole + F.when(F.col("_before") + size / 2 <= rest, 1).otherwise(0))).otherwise(0)
    classes = F.array(*[F.lit(float(e)) for e in early])
    start = F.get(classes, F.pmod(F.col("weight") - 1, F.lit(len(early))).cast("int"))
    placed = placed.withColumn("copies", copies.cast("long")).withColumn("_early", start)
    times = F.transform(F.sequence(F.lit(0), F.col("copies").cast("int") - 1),
                        lambda k: position_of((k * F.col("source_size") + F.col("_before")) / F.col("target"), F.col("_early")))
    return placed.select("doc_id", "source", *keep, "size", "source_size", "weight", "target", "copies",
                         (F.col("copies") * size).alias("taken"),
                         F.when(F.col("copies") > 0, times).otherwise(F.array().cast("array<double>")).alias("positions"))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy (``copy`` counts a document's from 0), range-sorted by training position (ties by id)."""
    return (mixed.select("*", F.posexplode("positions").alias("copy", "position")).drop("positions")
            .repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id"))
