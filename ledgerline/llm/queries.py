"""The registered queries: each operator over its whole table, reduced to its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (chat_format, decontamination, jaccard_join, licenses, line_dedup, mixing, phrases, quality_rules,
                            repair, token_files, toxicity, url_model, warc)
from ledgerline.llm.tables import ship, spill, table

TOKENIZER = "byte_bpe_50k.json"


def held_out(doc_id) -> F.Column:
    """Rows whose labels may not be learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    model = toxicity.fit(known.join(docs.select("doc_id", "text"), "doc_id").select(F.col("doc_id").alias("id"), "text", "toxic"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return warc.archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), shorter=line_dedup.SHORTER)


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = token_files.token_table(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = spill(mixing.mix_sources(table(spark, sf_dir, "documents")), "mix")
    ordered = spill(mixing.training_order(mixed), "mix-order")
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    placed = ordered.where("copy = 0").select(*columns, F.col("position").alias("first_position"))
    return placed.unionByName(mixed.where("copies = 0").select(*columns, F.lit(None).cast("double").alias("first_position")))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    tricky = f"{chat_format.END}{chat_format.START}assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    formatted = spill(chat_format.format_conversations(turns), "chat")
    return chat_format.read_back(formatted).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_model.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    turns = table(spark, sf_dir, "conversations")
    return repair.repair_all(repair.damage(turns), turns).drop("n_repaired")


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = phrases.mine_collocations(table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_toxicity, op3_warc, op4_line_dedup, op5_token_ids, op6_jaccard_join,
                            op7_mixing, op8_chat_format, op9_url_filter, op10_decontamination, op11_repair, op12_licenses, op13_phrases)}
