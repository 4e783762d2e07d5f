"""Operator queries: ingest transforms, top-k reports, sinks, streams and
data-quality checks, each run over data derived from the driver tables.

Sink and stream queries land their inputs and write their outputs under a
fresh folder of the session's shared scratch root (``spark.checkpoint.dir``)
and return the read-back table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.json_codec import (decode_tick_messages, encode_tick_messages,
                                             intraday_rejects, intraday_rows,
                                             parse_response_bodies, split_decoded)
from ledgerline.functions.names import sanitize_columns
from ledgerline.functions.numeric import earnings_surprise
from ledgerline.functions.timecols import floor_to_interval, naive_epoch_micros, split_date_time
from ledgerline.operators import quality, sinks
from ledgerline.operators.rollup import daily_ohlcv
from ledgerline.operators.topk import latest_per_key, newest_per_key, newest_rows
from ledgerline.plans import runner
from ledgerline.plans.marts import crypto_daily_avg
from ledgerline.plans.queries import ROUNDED, fixture_warehouse, query, rounded
from ledgerline.schemas import TICK_SCHEMA, TICK_SPLIT_SCHEMA
from ledgerline.session import fresh_dir
from ledgerline.sources import landing
from ledgerline.sources.catalog import Warehouse
from ledgerline.sources.feeds import append_rows, compact, expire, write_batch
from ledgerline.sources.files import csv_by_header, csv_dir_scan, landed_responses, message_files
from ledgerline.sources.typed import TypedSources
from ledgerline.streaming import fallback
from ledgerline.streaming import ticks as stream

TICK_COLS = ["symbol", "timestamp", "open", "high", "low", "close", "volume"]

# Header text of the landed economy CSV, as published datasets spell it.
ECONOMY_HEADERS = {"Year": " Year", "Country": "Country ",
                   "Gross_Domestic_Product_GDP": "Gross Domestic Product (GDP)"}
CSV_TS_OPTIONS = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


# -- shared inputs ---------------------------------------------------------------
def _parsed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land API responses built from the ticks and parse them back."""
    wh = fixture_warehouse(spark, sf_dir)
    path = landing.land_responses(wh.source("tick_events"), fresh_dir(spark, "responses"))
    return parse_response_bodies(landed_responses(spark, path))


def _json_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intraday_rows(_parsed_responses(spark, sf_dir))


def _decoded_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = fixture_warehouse(spark, sf_dir)
    path = landing.land_messages(wh.ref("stg_test_realtime_stock_data"), fresh_dir(spark, "topic"))
    good, _ = split_decoded(decode_tick_messages(message_files(spark, path)))
    return good


# -- sources and parsing ------------------------------------------------------
@query("csv_dir_scan")
def q_csv_dir_scan(spark, sf_dir):
    wh = fixture_warehouse(spark, sf_dir)
    path = landing.land_csv(wh.source("sandp500_data"), fresh_dir(spark, "csv-sandp500"))
    return csv_dir_scan(spark, path)


@query("sanitize_columns")
def q_sanitize_columns(spark, sf_dir):
    raw = fixture_warehouse(spark, sf_dir).source("global_economy_indicators")
    messy = raw.select(*[F.col(c).alias(ECONOMY_HEADERS[c]) for c in raw.columns])
    return sanitize_columns(messy)


@query("intraday_json_parse")
def q_intraday_json_parse(spark, sf_dir):
    return _json_bars(spark, sf_dir)


@query("intraday_json_rejects")
def q_intraday_json_rejects(spark, sf_dir):
    return intraday_rejects(_parsed_responses(spark, sf_dir))


@query("latest_bar_from_json")
def q_latest_bar_from_json(spark, sf_dir):
    bars = _json_bars(spark, sf_dir)
    return latest_per_key(bars, "symbol", "timestamp", TICK_COLS[1:])


@query("recent_ticks")
def q_recent_ticks(spark, sf_dir):
    return newest_rows(_json_bars(spark, sf_dir), 5, "timestamp", tie=("symbol",))


@query("recent_ticks_per_symbol")
def q_recent_ticks_per_symbol(spark, sf_dir):
    return newest_per_key(_json_bars(spark, sf_dir), "symbol", 5, "timestamp", tie=TICK_COLS[2:])


@query("latest_tick_per_symbol")
def q_latest_tick_per_symbol(spark, sf_dir):
    ticks = fixture_warehouse(spark, sf_dir).ref("stg_test_realtime_stock_data")
    return latest_per_key(ticks, "symbol", "timestamp", ["timestamp", "close", "volume"])


@query("kafka_record_encode")
def q_kafka_record_encode(spark, sf_dir):
    return encode_tick_messages(fixture_warehouse(spark, sf_dir).ref("stg_test_realtime_stock_data"))


@query("kafka_record_decode")
def q_kafka_record_decode(spark, sf_dir):
    return _decoded_messages(spark, sf_dir)


@query("split_date_time")
def q_split_date_time(spark, sf_dir):
    return split_date_time(fixture_warehouse(spark, sf_dir).source("streaming_stock_data"))


@query("union_tick_feeds")
def q_union_tick_feeds(spark, sf_dir):
    bars = _json_bars(spark, sf_dir)
    live = latest_per_key(bars, "symbol", "timestamp", TICK_COLS[1:])
    recent = newest_per_key(bars, "symbol", 5, "timestamp")
    consumed = _decoded_messages(spark, sf_dir)
    return (live.to(TICK_SCHEMA).unionByName(recent.to(TICK_SCHEMA))
            .unionByName(consumed.to(TICK_SCHEMA)))


@query("floor_to_interval")
def q_floor_to_interval(spark, sf_dir):
    ticks = fixture_warehouse(spark, sf_dir).ref("stg_test_realtime_stock_data")
    return ticks.select("symbol", "timestamp",
                        floor_to_interval(F.col("timestamp"), 5).alias("bucket_start"))


@query("earnings_surprise")
def q_earnings_surprise(spark, sf_dir):
    e = fixture_warehouse(spark, sf_dir).ref("stg_test_earnings")
    return e.select("symbol", "date", "est_eps", "actual_eps",
                    earnings_surprise(F.col("est_eps"), F.col("actual_eps")).alias("surprise_pct"))


@query("crypto_daily_avg")
def q_crypto_daily_avg(spark, sf_dir):
    return rounded(crypto_daily_avg(fixture_warehouse(spark, sf_dir)), ROUNDED["crypto_daily_avg"])


# -- sinks ------------------------------------------------------------------------
@query("append_sink")
def q_append_sink(spark, sf_dir):
    target = fresh_dir(spark, "append") + "/streaming_stock_data"
    sinks.append_sink(fixture_warehouse(spark, sf_dir).ref("stg_streaming_stock_data"), target)
    return spark.read.parquet(target)


@query("static_load")
def q_static_load(spark, sf_dir):
    raw = fixture_warehouse(spark, sf_dir).source("global_economy_indicators")
    csv_path = landing.land_csv(raw, fresh_dir(spark, "csv-economy"), ECONOMY_HEADERS)
    out = fresh_dir(spark, "static")
    sinks.static_load(csv_dir_scan(spark, csv_path), f"{out}/global_economy_indicators",
                      export_root=f"{out}/export")
    return spark.read.parquet(f"{out}/global_economy_indicators")


@query("schema_append")
def q_schema_append(spark, sf_dir):
    recent = newest_per_key(_json_bars(spark, sf_dir), "symbol", 5, "timestamp")
    # Columns arrive reordered and with an extra field; the sink conforms them.
    shuffled = recent.select("volume", "close", "symbol", "timestamp", "low", "high", "open",
                             F.lit("api").alias("feed"))
    target = fresh_dir(spark, "schema-append") + "/streaming_stock_data"
    sinks.schema_append(shuffled, target, TICK_SCHEMA)
    return spark.read.parquet(target)


@query("truncate_load")
def q_truncate_load(spark, sf_dir):
    df = fixture_warehouse(spark, sf_dir).source("test_sentiment")
    target = fresh_dir(spark, "truncate") + "/test_sentiment"
    export = fresh_dir(spark, "truncate-export")
    sinks.truncate_load(df, target, truncate=True)
    sinks.truncate_load(df, target, truncate=True, export_root=export)   # replaced, not doubled
    sinks.truncate_load(df, target, truncate=False)                      # appended
    return spark.read.parquet(target)


@query("parquet_export")
def q_parquet_export(spark, sf_dir):
    root = fresh_dir(spark, "export")
    sinks.parquet_export(fixture_warehouse(spark, sf_dir).ref("fact_daily_summary"), root,
                         "fact_daily_summary")
    return spark.read.parquet(f"{root}/fact_daily_summary")


@query("fallback_sink")
def q_fallback_sink(spark, sf_dir):
    df = fixture_warehouse(spark, sf_dir).ref("stg_streaming_stock_data")
    out = fresh_dir(spark, "fallback")
    # The warehouse connector is not installed here, so the primary write
    # fails and the rows go to the CSV fallback.
    sinks.with_fallback(df, "market.streaming_stock_data", f"{out}/csv", fmt="warehouse",
                        fallback_options=CSV_TS_OPTIONS)
    return spark.read.schema(TICK_SCHEMA).options(**CSV_TS_OPTIONS).csv(f"{out}/csv")


@query("load_counts")
def q_load_counts(spark, sf_dir):
    """Rows that loads report, beside those that are stored and exported."""
    wh = fixture_warehouse(spark, sf_dir)
    out = fresh_dir(spark, "load-counts")
    economy, sentiment = f"{out}/global_economy_indicators", f"{out}/test_sentiment"
    loads = [("static", sinks.static_load(wh.source("global_economy_indicators"), economy, export_root=f"{out}/export"), economy),
             ("truncate", sinks.truncate_load(wh.source("test_sentiment"), sentiment, export_root=f"{out}/export"), sentiment)]
    def counted(name, column, path):
        return spark.read.parquet(path).select(F.lit(name).alias("load"), F.lit(column).alias("kind"))

    reported = spark.createDataFrame([(name, n) for name, n, _ in loads], "load string, observed bigint")
    kept = [counted(name, kind, path) for name, _, table in loads
            for kind, path in (("stored", table), ("exported", f"{out}/export/{table.rsplit('/', 1)[-1]}"))]
    counts = (reduce(DataFrame.unionByName, kept).groupBy("load")
              .agg(F.count_if(F.col("kind") == "stored").alias("stored"), F.count_if(F.col("kind") == "exported").alias("exported")))
    return reported.join(counts, "load", "left").select("load", "observed", "stored", "exported")


@query("csv_by_header")
def q_csv_by_header(spark, sf_dir):
    """CSV files whose columns stand in two orders, one kind with a column more and one less."""
    index = fixture_warehouse(spark, sf_dir).source("sandp500_data")
    out = fresh_dir(spark, "csv-headers")
    odd = F.dayofmonth("Date") % 2 == 1
    landing.land_csv(index.where(~odd), f"{out}/even")
    landing.land_csv(index.where(odd).select("Volume", "Close", F.lit("x, y").alias("Note"), "Low", "High", "Date"), f"{out}/odd")
    return csv_by_header(spark, out, "Date date, Open double, High double, Low double, Close double, Volume bigint")


@query("typed_raw_load")
def q_typed_raw_load(spark, sf_dir):
    """Earnings events of a file of text, in which a missing figure is NaN, through the declared types."""
    raw = fixture_warehouse(spark, sf_dir).source("test_earnings")
    text = raw.select("symbol", F.concat(F.col("date").cast("string"), F.lit(" ")).alias("date"),
                      *[F.coalesce(F.col(c).cast("string"), F.lit("NaN")).alias(c) for c in ("est_eps", "actual_eps", "surprise_pct")])
    path = landing.land_csv(text, fresh_dir(spark, "csv-earnings"))
    files = spark.read.option("header", True).schema(", ".join(f"{c} string" for c in text.columns)).csv(path)
    return Warehouse(spark, TypedSources(lambda name: files)).ref("int_test_earnings")


@query("daily_ohlcv_tied")
def q_daily_ohlcv_tied(spark, sf_dir):
    """The daily rollup over ticks whose times were cut to seconds, ties by the load id."""
    ticks = fixture_warehouse(spark, sf_dir).source("realtime_test_stock_data")
    seconds = F.timestamp_add("MICROSECOND", -F.pmod(naive_epoch_micros(F.col("timestamp")), F.lit(1_000_000)), F.col("timestamp"))
    return daily_ohlcv(ticks.withColumn("timestamp", seconds), tie="event_id")


# -- streaming ------------------------------------------------------------------
def _landed_tick_files(spark, sf_dir) -> str:
    ticks = fixture_warehouse(spark, sf_dir).ref("stg_test_realtime_stock_data")
    path = fresh_dir(spark, "tick-files")
    ticks.write.mode("overwrite").parquet(path)
    return path


@query("stream_tick_ingest")
def q_stream_tick_ingest(spark, sf_dir):
    wh = fixture_warehouse(spark, sf_dir)
    topic = landing.land_messages(wh.ref("stg_test_realtime_stock_data"), fresh_dir(spark, "topic"))
    out = fresh_dir(spark, "stream-ingest")
    stream.run_to_end(stream.ingest_ticks(stream.message_stream(spark, topic),
                                          f"{out}/table", f"{out}/_checkpoint"))
    return stream.read_batches(spark, f"{out}/table")


@query("stream_dual_sink")
def q_stream_dual_sink(spark, sf_dir):
    src = stream.tick_file_stream(spark, _landed_tick_files(spark, sf_dir), TICK_SPLIT_SCHEMA)
    out = fresh_dir(spark, "stream-dual")
    stream.run_to_end(stream.dual_sink(src, f"{out}/topic", f"{out}/table", f"{out}/_checkpoint"))
    return stream.read_batches(spark, f"{out}/table")


@query("stream_recent_append")
def q_stream_recent_append(spark, sf_dir):
    wh = fixture_warehouse(spark, sf_dir)
    landed = landing.land_responses(wh.source("tick_events"), fresh_dir(spark, "responses"))
    out = fresh_dir(spark, "stream-recent")
    stream.run_to_end(stream.recent_append(stream.response_stream(spark, landed),
                                           f"{out}/table", f"{out}/_checkpoint", n=5))
    return stream.read_batches(spark, f"{out}/table")


@query("stream_rejects")
def q_stream_rejects(spark, sf_dir):
    wh = fixture_warehouse(spark, sf_dir)
    landed = landing.land_responses(wh.source("tick_events"), fresh_dir(spark, "responses"))
    out = fresh_dir(spark, "stream-rejects")
    stream.run_to_end(stream.dead_letter_responses(stream.response_stream(spark, landed),
                                                   f"{out}/dead_letter", f"{out}/_checkpoint"))
    return spark.read.parquet(f"{out}/dead_letter")


@query("stream_daily_ohlcv")
def q_stream_daily_ohlcv(spark, sf_dir):
    src = stream.tick_file_stream(spark, _landed_tick_files(spark, sf_dir), TICK_SPLIT_SCHEMA)
    out = fresh_dir(spark, "stream-ohlcv")
    stream.run_to_end(stream.daily_ohlcv_stream(src, f"{out}/changelog", f"{out}/_checkpoint"))
    return stream.read_daily(spark, f"{out}/changelog")


@query("stream_latest_tick")
def q_stream_latest_tick(spark, sf_dir):
    src = stream.tick_file_stream(spark, _landed_tick_files(spark, sf_dir), TICK_SPLIT_SCHEMA)
    out = fresh_dir(spark, "stream-latest")
    stream.run_to_end(stream.latest_tick_stream(src, f"{out}/changelog", f"{out}/_checkpoint"))
    return stream.read_latest(spark, f"{out}/changelog")


# One file per micro-batch, in no order of time.
ONE_FILE = {"maxFilesPerTrigger": "1"}


def _shuffled_tick_files(spark, sf_dir) -> str:
    ticks = fixture_warehouse(spark, sf_dir).ref("stg_test_realtime_stock_data")
    path = fresh_dir(spark, "tick-files")
    ticks.repartition(8).write.mode("overwrite").parquet(path)
    return path


@query("stream_compacted_table")
def q_stream_compacted_table(spark, sf_dir):
    """A table written one file per batch, compacted twice, read from the compacted part alone."""
    src = stream.tick_file_stream(spark, _shuffled_tick_files(spark, sf_dir), TICK_SPLIT_SCHEMA, ONE_FILE)
    out = fresh_dir(spark, "stream-compacted")
    stream.run_to_end(stream.dual_sink(src, f"{out}/topic", f"{out}/table", f"{out}/_checkpoint"))
    stream.compact_batches(spark, f"{out}/table")
    stream.compact_batches(spark, f"{out}/table")
    return stream.read_batches(spark, f"{out}/table")


@query("stream_changelog_compacted")
def q_stream_changelog_compacted(spark, sf_dir):
    """The daily rollup over shuffled files, one per batch, compacted."""
    src = stream.tick_file_stream(spark, _shuffled_tick_files(spark, sf_dir), TICK_SPLIT_SCHEMA, ONE_FILE)
    out = fresh_dir(spark, "stream-ohlcv-compacted")
    stream.run_to_end(stream.daily_ohlcv_stream(src, f"{out}/changelog", f"{out}/_checkpoint"))
    stream.compact_changelog(spark, f"{out}/changelog")
    return stream.read_daily(spark, f"{out}/changelog")


@query("levelled_daily_bars")
def q_levelled_daily_bars(spark, sf_dir):
    """The daily rollup from partial bars of twelve batches, compacted in levels after each and what is covered
    expired.  Days are spread over the batches, so bars meet again in parts of every level."""
    ticks = fixture_warehouse(spark, sf_dir).ref("stg_test_realtime_stock_data")
    root, batches = f"{fresh_dir(spark, 'levelled')}/bars", 12
    turn = F.pmod(F.hash("symbol", "timestamp"), F.lit(batches))
    # one shuffle for all batches: each is a folder of this table
    slices = fresh_dir(spark, "levelled-slices")
    ticks.withColumn("_turn", turn).repartition("_turn").write.mode("overwrite").partitionBy("_turn").parquet(slices)
    for n in range(batches):
        batch = spark.read.parquet(slices).where(F.col("_turn") == n).drop("_turn")  # prunes to its folder
        write_batch(stream.daily_partials(batch), root, n, "batch", "bars")
        compact(spark, root, stream.merge_daily, fanout=3)
        expire(spark, root, 0)
    return stream.read_daily(spark, root)


@query("shared_tick_table")
def q_shared_tick_table(spark, sf_dir):
    """One table, many writers: consumers of two topics, one of them again from a fresh checkpoint after
    a compaction, the recent-bars poller, a batch append and a plain append."""
    wh = fixture_warehouse(spark, sf_dir)
    ticks = wh.ref("stg_test_realtime_stock_data")
    # two topics that hold every tick once between them
    second = F.pmod(F.crc32(F.col("symbol").cast("binary")), F.lit(2)) == 1
    topic = landing.land_messages(ticks.where(~second), fresh_dir(spark, "topic"))
    other = landing.land_messages(ticks.where(second), fresh_dir(spark, "topic"))
    landed = landing.land_responses(wh.source("tick_events"), fresh_dir(spark, "responses"))
    out = fresh_dir(spark, "shared")
    table = f"{out}/table"
    stream.run_to_end(stream.ingest_ticks(stream.message_stream(spark, topic), table, f"{out}/_ingest"))
    stream.run_to_end(stream.ingest_ticks(stream.message_stream(spark, other), table, f"{out}/_ingest_other"))
    stream.run_to_end(stream.recent_append(stream.response_stream(spark, landed), table, f"{out}/_recent", n=5))
    stream.compact_batches(spark, table)
    bars = intraday_rows(parse_response_bodies(landed_responses(spark, landed)))
    latest = latest_per_key(bars, "symbol", "timestamp", TICK_COLS[1:]).to(TICK_SCHEMA)
    append_rows(latest, table)
    stream.run_to_end(stream.ingest_ticks(stream.message_stream(spark, topic), table, f"{out}/_ingest_again"))
    sinks.append_sink(latest, table)
    return stream.read_batches(spark, table)


@query("message_rejects")
def q_message_rejects(spark, sf_dir):
    """Rejects of a topic in which four of ten minutes hold bad messages, and the number of ticks stored beside them."""
    ticks = fixture_warehouse(spark, sf_dir).ref("stg_test_realtime_stock_data")
    minute = F.minute("timestamp") % 10
    many = F.concat(F.lit('{"symbol":"'), F.col("symbol"), F.lit('","timestamp":"2024-01-01T00:00:00","volume":"many"}'))
    bad = (F.when(minute == 1, F.lit("{}")).when(minute == 2, F.concat(F.lit("not json "), F.col("symbol")))
           .when(minute == 3, many))  # and no value at all in the first minute
    planted = ticks.where(minute <= 3).select(F.col("symbol").alias("key"), bad.alias("value"))
    topic, out = fresh_dir(spark, "topic"), fresh_dir(spark, "rejects")
    encode_tick_messages(ticks.where(minute > 3)).unionByName(planted).write.mode("overwrite").json(topic)
    stream.run_to_end(stream.ingest_and_reject(stream.message_stream(spark, topic), f"{out}/table", f"{out}/rejects", f"{out}/_checkpoint"))
    stored = stream.read_batches(spark, f"{out}/table").agg(F.count(F.lit(1)).cast("string").alias("raw"), F.lit("stored").alias("reason"))
    return stream.read_batches(spark, f"{out}/rejects").select("raw", "reason").unionByName(stored)


@query("stream_fallback")
def q_stream_fallback(spark, sf_dir):
    """A table that every other micro-batch cannot be loaded into, and the batches in its fallback."""
    src = stream.tick_file_stream(spark, _shuffled_tick_files(spark, sf_dir), TICK_SPLIT_SCHEMA, ONE_FILE)
    out = fresh_dir(spark, "stream-fallback")
    load, undo = fallback.feed_primary(f"{out}/table")
    broken, _ = fallback.connector_primary("market.streaming_stock_data", "warehouse")  # not installed here

    def alternating(df, n, writer):
        (broken if n % 2 else load)(df, n, writer)
    stream.run_to_end(fallback.routed_append(src.select(*TICK_COLS), (alternating, undo), f"{out}/fallback", f"{out}/_checkpoint",
                                             stream.REPLAY, CSV_TS_OPTIONS))
    return (stream.read_batches(spark, f"{out}/table")
            .unionByName(fallback.read_fallback(spark, f"{out}/fallback", TICK_SCHEMA, CSV_TS_OPTIONS)))


@query("publish_messages")
def q_publish_messages(spark, sf_dir):
    """A batch produced twice, as after a lost producer; the consumer reads each message once."""
    messages = encode_tick_messages(fixture_warehouse(spark, sf_dir).ref("stg_test_realtime_stock_data"))
    topic, out = fresh_dir(spark, "topic"), fresh_dir(spark, "published")
    for _ in range(2):
        sinks.publish_messages(messages, topic, "json")
    unique = stream.unique_messages(stream.message_stream(spark, topic, arrival=True))
    stream.run_to_end(stream.ingest_ticks(unique, f"{out}/table", f"{out}/_checkpoint"))
    return stream.read_batches(spark, f"{out}/table")


@query("built_tick_fact")
def q_built_tick_fact(spark, sf_dir):
    """The tick fact as the runner stores it (by day, rebalanced), read back."""
    out = fresh_dir(spark, "built")
    runner.build(fixture_warehouse(spark, sf_dir), out, names=["fact_stock_tick"])
    return spark.read.parquet(f"{out}/fact_stock_tick")


# -- data quality -------------------------------------------------------------------
def _checks(kind: str | None):
    return [c for c in quality.CHECKS if kind is None or c.test == kind]


@query("dq_results_stored")
def q_dq_results_stored(spark, sf_dir):
    return quality.run_checks_stored(fixture_warehouse(spark, sf_dir), fresh_dir(spark, "checked"))


for _name, _kind in (("dq_not_null", "not_null"), ("dq_unique", "unique"),
                     ("dq_unique_combination", "unique_combination"), ("dq_results", None)):
    query(_name)((lambda k: lambda spark, sf_dir: quality.run_checks(
        fixture_warehouse(spark, sf_dir), _checks(k)))(_kind))
