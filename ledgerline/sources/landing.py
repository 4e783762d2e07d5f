"""Land fixture inputs (CSV files, API responses, topic messages) derived
from the raw tables.

These writers give the ingest operators real files to read whose size grows
with the driver tables.  They are Spark jobs: rows are grouped and encoded on
the executors and written in parallel, never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.json_codec import (METRIC_KEYS, SERIES_KEY_1MIN,
                                             encode_tick_messages)

# Ticks per landed response.  A response groups one symbol's ticks of one
# block of consecutive event ids, so with an id per tick no response holds more
# than this many bars, however many ticks a symbol has.
RESPONSE_BLOCK = 64


def land_csv(df: DataFrame, path: str, headers: dict[str, str] | None = None) -> str:
    """Write ``df`` as header CSV files (one per partition) under ``path``;
    ``headers`` renames columns to the header text wanted in the files."""
    out = df.select(*[F.col(c).alias((headers or {}).get(c, c)) for c in df.columns])
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def response_records(ticks: DataFrame) -> DataFrame:
    """Group ticks (with ``event_id``, ``event_type`` and the 7 tick columns)
    into API-style responses ``(symbol, request_id, body)``.

    Fixture rules, so that every parser branch sees data:

    * beside a response whose first tick is an ``error`` event lands an error
      body, beside one whose first tick is a ``signup`` event a throttling
      note (records of their own, so that every tick is parsed);
    * ``view`` ticks omit the volume metric (parsed as 0).

    Bar keys are the full-precision timestamps, unique within a response as an
    API's are.  Ticks of one symbol, block and timestamp (repeated event ids)
    go to further responses of the same request, so no bar is dropped and none
    fails the job; a request's responses land in one file.
    """
    metrics = F.map_from_arrays(
        F.array(*[F.lit(METRIC_KEYS[m]) for m in ("open", "high", "low", "close", "volume")]),
        F.array(*[F.col(m).cast("string") for m in ("open", "high", "low", "close", "volume")]))
    metrics = F.when(F.col("event_type") == "view",
                     F.map_filter(metrics, lambda k, v: k != F.lit(METRIC_KEYS["volume"]))
                     ).otherwise(metrics)
    # 'yyyy-MM-dd HH:mm:ss[.ffffff]': the naive value's own string form.
    bar_key = F.col("timestamp").cast("string")
    same_bar = Window.partitionBy("symbol", "request_id", "timestamp").orderBy("event_id")
    blocks = (ticks
              .withColumn("request_id", F.floor(F.col("event_id") / RESPONSE_BLOCK).cast("bigint"))
              # one shuffle serves the numbering and both groupings
              .repartition("symbol", "request_id")
              .withColumn("page", F.row_number().over(same_bar))
              .groupBy("symbol", "request_id", "page")
              .agg(F.map_from_entries(F.collect_list(F.struct(bar_key, metrics))).alias("series"),
                   F.min_by("event_type", "event_id").alias("first_type"), F.min("event_id").alias("first_id"))
              .groupBy("symbol", "request_id")
              .agg(F.collect_list("series").alias("pages"), F.min_by("first_type", "first_id").alias("first_type")))
    good = F.transform("pages", lambda series: F.to_json(F.struct(
        F.struct(F.col("symbol").alias("2. Symbol")).alias("Meta Data"),
        series.alias(SERIES_KEY_1MIN))))
    error_body = F.to_json(F.struct(F.lit("Invalid API call for this symbol.").alias("Error Message")))
    note_body = F.to_json(F.struct(F.lit("Call frequency limit reached; retry later.").alias("Note")))
    notice = F.when(F.col("first_type") == "error", error_body).when(F.col("first_type") == "signup", note_body)
    bodies = F.filter(F.concat(good, F.array(notice)), lambda b: b.isNotNull())
    return blocks.select("symbol", "request_id", F.explode(bodies).alias("body"))


def land_responses(ticks: DataFrame, path: str) -> str:
    response_records(ticks).write.mode("overwrite").json(path)
    return path


def land_messages(ticks_split: DataFrame, path: str) -> str:
    """Write ticks (9-column form) as keyed JSON messages ``{key, value}``."""
    encode_tick_messages(ticks_split).write.mode("overwrite").json(path)
    return path
