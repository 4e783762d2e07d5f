"""The corpus pipeline: five stages of ledgerline.llm over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and reread as the next one's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, jaccard_join, mixing, quality_rules, token_files
from ledgerline.llm.queries import TOKENIZER
from ledgerline.llm.tables import ship, spill, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    return quality_rules.judge_quality(rows, keep=["_row"]).where("kept").select("_row.*")


#: The stage's own threshold; op6's contract (3 words, 90) binds that query only.
NEAR_PERCENT, NEAR_WORDS = 80, 5


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.

    Rows of one id and equal texts are one document; rows of one id with other
    texts are documents of their own and go only as near copies.  Of equal ids
    in a group the first by text hash stays; rows without an id stay, as
    nothing can name them.
    """
    ship(spark)
    k1, k2 = decontamination.row_key(F.col("doc_id").cast("long"), F.col("text"))
    keyed = docs.where("doc_id is not null").select("*", k1.alias("_k1"), k2.alias("_k2"))
    # a node for each id and text, as rows of one id need not be near each other; texts that only share half a key get a node of their own
    halves = keyed.groupBy("_k1").agg(F.min("_k2").alias("_low"), F.max("_k2").alias("_high")).where("_low < _high")
    halves = spill(halves.select(F.col("_k1").alias("_half"), "_low"), "pipeline-halves")
    own = F.col("_half").isNull() | (F.col("_k2") == F.col("_low"))
    named = keyed.join(halves, F.col("_k1") == F.col("_half"), "left").withColumn("_node", F.when(own, F.col("_k1")).otherwise(F.xxhash64("_k1", "_k2")))
    found = jaccard_join.jaccard_components(named.select("_node", "text"), percent=NEAR_PERCENT, k=NEAR_WORDS, id_col="_node")
    found = spill(found.select(F.col("doc_id").alias("_node"), "component_id").distinct(), "pipeline-components")
    ids = named.select("_node", "doc_id").distinct()
    stays = found.join(ids, "_node").groupBy("component_id").agg(F.min(F.struct("doc_id", "_node")).alias("_m")).select("_m._node")
    once = W.partitionBy("_node", "_k2").orderBy("doc_id")
    kept = named.join(stays, "_node", "left_semi").withColumn("_n", F.row_number().over(once)).where("_n = 1")
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    ship(spark)
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    leaks = spill(found.where("contaminated").select("k1", "k2").distinct(), "pipeline-leaks")
    k1, k2 = decontamination.row_key(F.col("doc_id").cast("long"), F.col("text"))
    marked = docs.select("*", k1.alias("_k1"), k2.alias("_k2"))
    return marked.join(leaks, (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2")), "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target asks (or not at all), in training order."""
    rows = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("_row"))
    mixed = mixing.mix_sources(rows, keep=["_row"])
    return mixing.training_order(mixed.select("doc_id", "_row", "positions")).select("_row.*")


def _numbered(docs: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """``docs`` with its order as columns, and their names: the order of the files' rows, or else of the frame's."""
    if not docs._jdf.queryExecution().analyzed().children().isEmpty():  # not files as they were written
        return docs.withColumn("_at", F.monotonically_increasing_id()), ("_at",)
    number = lambda pattern: F.coalesce(F.regexp_extract("_metadata.file_name", pattern, 1).try_cast("long"), F.lit(0).cast("long"))
    return (docs.select("*", number(r"^part-(\d+)").alias("_part"), number(r"-c(\d+)\.").alias("_chunk"), F.col("_metadata.row_index").alias("_at")),
            ("_part", "_chunk", "_at"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix in its training order, read back: doc_id, start, n_tokens, ids_crc32 of each copy."""
    ship(spark)
    docs, order = _numbered(docs)
    rows = token_files.token_table(docs, public_tokenizers.path(TOKENIZER), order_cols=order)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontaminate),
          ("mixing sources to target weights", mix), ("token-ID / binary output", tokens)]

#: Expectation-maximisation and byte-pair encoding have no SQL form; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = spill(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs
