"""Structured Streaming versions of tick ingest and the tick rollups.

Sources are a Kafka topic in production (``format="kafka"``) or a directory
of message files with the same ``key``/``value`` payload (tests, replays).
Every query is checkpointed under a caller-supplied location on shared
storage, so a restarted driver or lost executor resumes from the last
committed batch:

* every writer puts each micro-batch in a folder of its own with overwrite
  (``sources.feeds``), so a replayed batch replaces its own output, several
  writers share one table, and compaction keeps reads bounded;
* the daily rollup and the latest tick are written as mergeable partial rows
  per micro-batch: first / last values carry their order key, so a late tick
  changes its day whenever it arrives and the result does not depend on how
  the stream was cut into batches (``read_daily``, ``read_latest``).  The
  daily rollup can instead emit closed days once (append mode, watermark).

Triggers: ``{"availableNow": True}`` drains what is there and stops
(replays, tests); ``{"processingTime": "5 minutes"}`` is the live cadence.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions.json_codec import (decode_tick_messages, encode_tick_messages,
                                             intraday_rejects, intraday_rows,
                                             parse_response_bodies,
                                             split_decoded)
from ledgerline.functions.timecols import naive_epoch_micros
from ledgerline.operators.rollup import ohlcv_aggregates, ohlcv_order_key, row_tie, tick_order_key
from ledgerline.operators.topk import newest_per_key
from ledgerline.schemas import TICK_SCHEMA
from ledgerline.session import apply_streaming_state_conf
from ledgerline.sources.feeds import batch_dir, compact, is_feed_table, read_batches, write_batch, writer_of
from ledgerline.sources.files import LANDED_RESPONSE_SCHEMA, MESSAGE_FILE_SCHEMA
from ledgerline.streaming.fallback import feed_primary, routed_writer

REPLAY = {"availableNow": True}
LIVE = {"processingTime": "5 minutes"}


# -- sources ----------------------------------------------------------------
def message_stream(spark: SparkSession, location: str, fmt: str = "files",
                   options: Mapping[str, str] | None = None, arrival: bool = False) -> DataFrame:
    """Keyed tick messages as a stream with ``key``/``value`` columns, with
    ``arrival`` also ``arrived``: when the topic took the message (for files:
    when the file was written).

    ``fmt="kafka"``: ``location`` is the topic, ``options`` must carry
    ``kafka.bootstrap.servers``; reading starts at the earliest offset.
    ``fmt="files"``: JSON-lines ``{key, value}`` files under ``location``.
    """
    if fmt == "kafka":
        return (spark.readStream.format("kafka")
                .option("subscribe", location)
                .option("startingOffsets", "earliest")
                .options(**dict(options or {}))
                .load()
                .select(F.col("key").cast("string"), F.col("value").cast("string"),
                        *([F.col("timestamp").alias("arrived")] if arrival else [])))
    messages = spark.readStream.schema(MESSAGE_FILE_SCHEMA).options(**dict(options or {})).json(location)
    if not arrival:
        return messages
    return messages.select("key", "value", F.col("_metadata.file_modification_time").alias("arrived"))


def unique_messages(messages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Messages without the copies that a replayed producer batch leaves in the topic.

    ``messages`` has ``key``, ``value`` and ``arrived``.  Of messages with
    equal key and value that arrive within ``delay`` one stays.  The watermark
    runs on the arrival, not on the tick's own time: a late tick is never
    late here, so nothing but copies is dropped, and the state holds the
    messages of about one ``delay`` (in RocksDB).
    """
    apply_streaming_state_conf(messages.sparkSession)
    return messages.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["key", "value"]).select("key", "value")


def response_stream(spark: SparkSession, location: str,
                    options: Mapping[str, str] | None = None) -> DataFrame:
    """Landed API responses (JSON lines) as a stream."""
    return spark.readStream.schema(LANDED_RESPONSE_SCHEMA).options(**dict(options or {})).json(location)


def tick_file_stream(spark: SparkSession, location: str, schema,
                     options: Mapping[str, str] | None = None) -> DataFrame:
    """Tick rows landed as Parquet files, as a stream.  ``options`` such as
    ``maxFilesPerTrigger`` bound the size of each micro-batch."""
    return spark.readStream.schema(schema).options(**dict(options or {})).parquet(location)


# -- helpers --------------------------------------------------------------------
def _start(df: DataFrame, checkpoint: str, trigger: Mapping, name: str | None = None,
           **writer_opts) -> StreamingQuery:
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(**dict(trigger))
    if name:
        w = w.queryName(name)
    fmt = writer_opts.pop("format", None)
    mode = writer_opts.pop("outputMode", None)
    path = writer_opts.pop("path", None)
    fe = writer_opts.pop("foreachBatch", None)
    if fmt:
        w = w.format(fmt)
    if mode:
        w = w.outputMode(mode)
    if fe:
        w = w.foreachBatch(fe)
    return w.start(path) if path else w.start()


def _each_batch(write: Callable[[DataFrame, int], None]):
    """A foreachBatch body that reads its batch several times: keep it meanwhile."""
    def run(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            write(df, batch_id)
        finally:
            df.unpersist()
    return run


def _to_table(root: str, checkpoint: str, feed: str, rows: Callable[[DataFrame], DataFrame] = lambda df: df):
    """A foreachBatch body that adds ``rows`` of each batch to a feed table as the checkpoint's writer."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(rows(df), root, batch_id, feed, writer_of(df.sparkSession, checkpoint))
    return write


def run_to_end(q: StreamingQuery) -> None:
    """Block until an availableNow query has drained its input."""
    q.awaitTermination()
    if q.exception():
        raise q.exception()


# -- T-1: topic -> typed ticks -> table --------------------------------------
def ingest_ticks(messages: DataFrame, table_path: str, checkpoint: str,
                 trigger: Mapping = REPLAY) -> StreamingQuery:
    """Decode keyed JSON messages and append the good ones to a feed table
    (feed ``ingest``; a replayed batch replaces itself).  Malformed messages
    are excluded here and routed by ``dead_letter_messages``."""
    good = decode_tick_messages(messages).where(F.col("_corrupt").isNull()).drop("_corrupt")
    return _start(good, checkpoint, trigger,
                  foreachBatch=_to_table(table_path, checkpoint, "ingest"))


def ingest_and_reject(messages: DataFrame, table_path: str, reject_path: str, checkpoint: str,
                      trigger: Mapping = REPLAY) -> StreamingQuery:
    """As ``ingest_ticks``, and the malformed messages of the same micro-batch to a feed table of
    rejects (raw, reason): the topic is read once, under one checkpoint, and a replayed batch
    replaces both its sides."""
    good_side = _to_table(table_path, checkpoint, "ingest", lambda df: split_decoded(df)[0])
    bad_side = _to_table(reject_path, checkpoint, "reject", lambda df: split_decoded(df)[1])

    def write(df: DataFrame, batch_id: int) -> None:
        good_side(df, batch_id)
        bad_side(df, batch_id)
    return _start(decode_tick_messages(messages), checkpoint, trigger, foreachBatch=_each_batch(write))


# -- T-4: bad records -> dead-letter table -------------------------------------
def dead_letter_messages(messages: DataFrame, path: str, checkpoint: str,
                         trigger: Mapping = REPLAY) -> StreamingQuery:
    bad = (decode_tick_messages(messages).where(F.col("_corrupt").isNotNull())
           .select(F.col("_corrupt").alias("raw"), F.lit("malformed").alias("reason")))
    return _start(bad, checkpoint, trigger, format="parquet", outputMode="append", path=path)


def dead_letter_responses(responses: DataFrame, path: str, checkpoint: str,
                          trigger: Mapping = REPLAY) -> StreamingQuery:
    """Landed API responses without a price series -> dead-letter table."""
    rejects = intraday_rejects(parse_response_bodies(responses))
    return _start(rejects, checkpoint, trigger, format="parquet", outputMode="append", path=path)


# -- T-2: every tick to the topic and to the table --------------------------------
def dual_sink(ticks: DataFrame, topic_path: str, table_path: str, checkpoint: str,
              trigger: Mapping = REPLAY, topic_format: str = "json",
              topic_options: Mapping[str, str] | None = None) -> StreamingQuery:
    """Write each micro-batch both as keyed messages and as table rows.

    With ``topic_format="kafka"``, ``topic_path`` is the topic name and the
    batch is produced with the Kafka batch writer.  The table side is
    idempotent per batch (it overwrites its own folder); a Kafka topic is
    at-least-once: a batch replayed after a failure produces its messages
    again, so consumers should treat (symbol, timestamp) as the message key
    for de-duplication.  File topics are overwritten per batch like the table.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        msgs = encode_tick_messages(df)
        if topic_format == "kafka":
            (msgs.write.format("kafka").option("topic", topic_path)
             .options(**dict(topic_options or {})).save())
        else:
            msgs.write.mode("overwrite").format(topic_format).save(batch_dir(topic_path, batch_id, writer=writer_of(df.sparkSession, checkpoint)))
        to_table(df, batch_id)
    to_table = _to_table(table_path, checkpoint, "batch")
    return _start(ticks, checkpoint, trigger, foreachBatch=_each_batch(write))


# -- T-3: newest N bars of each response -> table ------------------------------
def recent_append(responses: DataFrame, table_path: str, checkpoint: str, n: int = 5,
                  trigger: Mapping = REPLAY, fallback_root: str | None = None) -> StreamingQuery:
    """Parse landed responses, keep the ``n`` newest bars of every response
    (symbol, request_id), conform to the tick schema and append (feed
    ``recent``).  With ``fallback_root`` a micro-batch that the table does not
    take goes there as CSV files (``streaming.fallback``).  The ranking is inside a response, so it does not depend on
    which responses share a micro-batch.  (A row_number is not allowed on a
    streaming frame, so it runs inside the batch.)"""
    def rows(df: DataFrame) -> DataFrame:
        return recent_per_response(parse_response_bodies(df), n)
    if fallback_root:
        write = routed_writer(feed_primary(table_path, "recent"), fallback_root, checkpoint, rows)
    else:
        write = _to_table(table_path, checkpoint, "recent", rows)
    return _start(responses, checkpoint, trigger, foreachBatch=write)


def recent_per_response(parsed: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest bars of each parsed response, in the tick schema."""
    bars = intraday_rows(parsed, keep=("request_id",))
    return newest_per_key(bars, ("symbol", "request_id"), n, "timestamp").drop("request_id").to(TICK_SCHEMA)


# -- T-6: live daily OHLCV -------------------------------------------------------
def daily_ohlcv_stream(ticks: DataFrame, changelog_path: str, checkpoint: str,
                       delay: str = "1 day", trigger: Mapping = REPLAY,
                       output: str = "changelog") -> StreamingQuery:
    """Daily OHLCV per symbol kept up to date as ticks arrive.

    ``output="changelog"`` writes one mergeable partial row per (symbol, day)
    and micro-batch; ``read_daily`` gives the table, including days still
    open.  There is no watermark: a tick counts whenever it arrives.

    ``output="closed"`` (append mode) writes each (symbol, day) exactly once,
    when the watermark passes the end of the day plus ``delay``, to an
    exactly-once Parquet file sink: final bars only, readable directly.  Ticks
    later than that are in the changelog form alone.
    """
    if output == "changelog":
        return _start(ticks, checkpoint, trigger,
                      foreachBatch=_to_table(changelog_path, checkpoint, "batch", daily_partials))
    naive = ticks.schema["timestamp"].dataType.typeName() == "timestamp_ntz"
    # Event time as a TIMESTAMP whose epoch is the naive wall clock, so the
    # 1-day windows are calendar days whatever the session time zone.
    event_time = (F.timestamp_micros(naive_epoch_micros(F.col("timestamp"))) if naive
                  else F.col("timestamp"))
    day_of = F.date_from_unix_date(
        F.floor(F.unix_micros(F.col("w.start")) / 86_400_000_000).cast("int"))
    agg = (ticks.withColumn("_et", event_time).withWatermark("_et", delay)
           .groupBy("symbol", F.window("_et", "1 day").alias("w"))
           .agg(*ohlcv_aggregates(ticks))  # the batch rollup's definition
           .select("symbol", day_of.alias("date"),
                   "open", "high", "low", "close", "volume"))
    apply_streaming_state_conf(agg.sparkSession)
    return _start(agg, checkpoint, trigger, format="parquet", outputMode="append", path=changelog_path)


def daily_partials(ticks: DataFrame) -> DataFrame:
    """Mergeable daily bars: the open and close carry the order key of their tick."""
    key = ohlcv_order_key(ticks)
    day = F.col("date") if "date" in ticks.columns else F.to_date("timestamp")
    rows = ticks.select("symbol", day.alias("date"), key.alias("first_key"), key.alias("last_key"),
                        "open", "high", "low", "close", "volume")
    return merge_daily(rows)


def merge_daily(partials: DataFrame) -> DataFrame:
    """Combine partial bars of the same (symbol, date); associative, so any grouping gives the same bars."""
    return partials.groupBy("symbol", "date").agg(
        F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"),
        F.min_by("open", "first_key").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "last_key").alias("close"), F.sum("volume").alias("volume"))


def read_daily(spark: SparkSession, root: str) -> DataFrame:
    """Daily OHLCV from all partial rows written so far."""
    return merge_daily(read_batches(spark, root)).select("symbol", "date", "open", "high", "low", "close", "volume")


# -- T-7: live latest tick per symbol ------------------------------------------
def latest_tick_stream(ticks: DataFrame, changelog_path: str, checkpoint: str,
                       trigger: Mapping = REPLAY) -> StreamingQuery:
    """Latest close/volume per symbol: one partial row per symbol and
    micro-batch, with the order key of its tick (``read_latest``)."""
    def partials(df: DataFrame) -> DataFrame:
        key = tick_order_key(row_tie("close", "volume"), "timestamp", df.schema["timestamp"].dataType.typeName() == "timestamp_ntz")
        rows = df.select("symbol", key.alias("last_key"), F.col("close").alias("last_close"),
                         F.col("volume").alias("last_volume"))
        return merge_latest(rows)
    return _start(ticks, checkpoint, trigger, foreachBatch=_to_table(changelog_path, checkpoint, "batch", partials))


def merge_latest(partials: DataFrame) -> DataFrame:
    """The row of the greatest order key of each symbol."""
    return partials.groupBy("symbol").agg(
        F.max("last_key").alias("last_key"), F.max_by("last_close", "last_key").alias("last_close"),
        F.max_by("last_volume", "last_key").alias("last_volume"))


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """Latest tick per symbol from all partial rows written so far."""
    return merge_latest(read_batches(spark, root)).select("symbol", "last_close", "last_volume")


def compact_changelog(spark: SparkSession, root: str) -> int | None:
    """Fold the partial rows of the batches so far (see ``feeds.compact``)."""
    daily = "first_key" in read_batches(spark, root).columns if is_feed_table(spark, root) else False
    return compact(spark, root, merge_daily if daily else merge_latest)


def compact_batches(spark: SparkSession, root: str) -> int | None:
    """Fold the batches so far into larger files (see ``feeds.compact``)."""
    return compact(spark, root)
