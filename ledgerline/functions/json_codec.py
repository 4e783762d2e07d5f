"""JSON codecs: intraday price responses and tick messages.

All parsing is column expressions (``from_json`` / ``to_json``), so it runs
inside whole-stage codegen on the executors; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerline.schemas import TICK_MESSAGE_SCHEMA

# Fixed values of the intraday price API responses (must match the API):
# the series key of 1-minute bars, the metric keys of a bar, and the
# top-level keys of a body that carries no series (throttling / errors).
SERIES_KEY_1MIN = "Time Series (1min)"
METRIC_KEYS = {"open": "1. open", "high": "2. high", "low": "3. low",
               "close": "4. close", "volume": "5. volume"}
NOTICE_KEYS = ("Note", "Information", "Error Message")


def series_key(interval: str = "1min") -> str:
    """Series key of a response for a bar interval (1min, 5min, 15min, ...)."""
    return f"Time Series ({interval})"


# Series keys are 'yyyy-MM-dd HH:mm:ss'; an optional fraction is accepted so
# sub-second bars keep distinct keys.
SERIES_TS_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$"
# Accepted on decode: 'T' or a space between date and time, optional fraction.
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def _response_schema(series_key: str) -> str:
    notices = ", ".join(f"`{k}`: string" for k in NOTICE_KEYS)
    return f"struct<`{series_key}`: map<string, map<string, string>>, {notices}, _corrupt: string>"


def parse_response_bodies(responses: DataFrame, body_col: str = "body",
                          series_key: str = SERIES_KEY_1MIN) -> DataFrame:
    """Add a parsed ``_r`` struct column to landed response records."""
    parsed = F.from_json(F.col(body_col), _response_schema(series_key),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return responses.withColumn("_r", parsed)


def series_time(key: Column) -> Column:
    """Parse a series key into a naive timestamp; NULL when it is not a valid
    'yyyy-MM-dd HH:mm:ss[.ffffff]' value.

    Built from the fields (one pattern check, fixed-position substrings) so
    the result never depends on the session time zone and a bad key cannot
    fail the job.
    """
    def part(start: int, length: int | None = None, t: str = "int") -> Column:
        s = key.substr(F.lit(start), F.lit(length) if length else F.length(key))
        return s.try_cast(t)
    ts = F.try_make_timestamp_ntz(part(1, 4), part(6, 2), part(9, 2), part(12, 2), part(15, 2),
                                  part(18, None, "decimal(8,6)"))
    return F.when(key.rlike(SERIES_TS_PATTERN), ts)


def _bars(parsed: DataFrame, symbol_col: str, series_key: str, keep=()) -> DataFrame:
    series = F.col("_r").getField(series_key)
    return (parsed.where(series.isNotNull())
            .select(F.col(symbol_col).alias("symbol"), *keep,
                    F.explode(series).alias("_ts", "_m"))
            .withColumn("timestamp", series_time(F.col("_ts"))))


def _metric(name: str) -> Column:
    """A metric as a double: missing is 0, unreadable is NULL."""
    return F.coalesce(F.try_element_at("_m", F.lit(METRIC_KEYS[name])), F.lit("0")).try_cast("double")


def _volume() -> Column:
    """The volume truncated to a long; NULL where it is no number or does not fit."""
    v = _metric("volume")
    return F.when(~F.isnan(v), v).try_cast("bigint")


def _readable() -> Column:
    """Whether every metric of a bar can be read."""
    ok = _volume().isNotNull()
    for name in ("open", "high", "low", "close"):
        ok = ok & _metric(name).isNotNull()
    return ok


def intraday_rows(parsed: DataFrame, symbol_col: str = "symbol",
                  series_key: str = SERIES_KEY_1MIN, keep: tuple[str, ...] = ()) -> DataFrame:
    """One OHLCV row per series entry of each accepted response.

    A missing metric defaults to 0 (as the API client did); every metric is
    read as a double and the volume truncated to a long.  Entries whose key
    is not a valid timestamp or whose metrics cannot be read are left to
    ``intraday_rejects``.  ``keep`` carries columns of the response along.
    """
    exploded = _bars(parsed, symbol_col, series_key, keep).where(F.col("timestamp").isNotNull() & _readable())
    return exploded.select(
        "symbol", *keep, "timestamp",
        *[_metric(m).alias(m) for m in ("open", "high", "low", "close")], _volume().alias("volume"))


def reject_reason(series_key: str = SERIES_KEY_1MIN) -> Column:
    r = F.col("_r")
    return (F.when(r.getField("_corrupt").isNotNull(), F.lit("malformed"))
            .when(r.getField("Note").isNotNull(), F.lit("note"))
            .when(r.getField("Information").isNotNull(), F.lit("information"))
            .when(r.getField("Error Message").isNotNull(), F.lit("error_message"))
            .otherwise(F.lit("missing_series")))


def intraday_rejects(parsed: DataFrame, keep: tuple[str, ...] = ("symbol", "request_id"),
                     series_key: str = SERIES_KEY_1MIN) -> DataFrame:
    """What the parser could not use, routed to a dead-letter table, not
    lost: responses without the series key (throttled, error or malformed
    bodies; ``detail`` NULL), series entries whose key is not a valid
    timestamp (reason ``bad_timestamp``) and entries with a metric that is no
    number (``bad_metric``); ``detail`` is the entry's key."""
    series = F.col("_r").getField(series_key)
    whole = (parsed.where(series.isNull())
             .select(*keep, reject_reason(series_key).alias("reason"),
                     F.lit(None).cast("string").alias("detail")))
    why = F.when(F.col("timestamp").isNull(), "bad_timestamp").when(~_readable(), "bad_metric")
    bars = (_bars(parsed, keep[0], series_key, keep[1:]).withColumn("reason", why).where(F.col("reason").isNotNull())
            .select(*keep, "reason", F.col("_ts").alias("detail")))
    return whole.unionByName(bars)


def require_series(parsed: DataFrame, series_key: str = SERIES_KEY_1MIN) -> DataFrame:
    """Strict mode: raise if any response lacks the series (the historical
    client raised on such a body); otherwise return ``parsed`` unchanged.
    Costs one short-circuiting scan (stops at the first reject)."""
    missing = parsed.where(F.col("_r").getField(series_key).isNull())
    if not missing.isEmpty():
        first = missing.select(reject_reason(series_key).alias("r")).first()
        raise ValueError(f"response without {series_key!r} ({first.r})")
    return parsed


def iso_timestamp(ts: Column) -> Column:
    """Naive timestamp -> ISO-8601 text ('yyyy-MM-ddTHH:mm:ss', plus a
    6-digit fraction only when non-zero).

    Built from the value's string form, which does not pass through the
    session time zone (``date_format`` would move a wall-clock time inside a
    daylight-saving gap).
    """
    # The string form is 'yyyy-MM-dd HH:mm:ss[.f]' with trailing zeros of the
    # fraction trimmed: swap in the 'T' and right-pad a fraction to 6 digits.
    text = ts.cast("string")
    iso = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 15))
    return F.when(F.length(text) > 19, F.rpad(iso, 26, "0")).otherwise(iso)


def encode_tick_messages(ticks: DataFrame) -> DataFrame:
    """Tick rows (9-column form) -> keyed messages ``(key, value)``.

    key = symbol; value = JSON object with the ISO timestamp and the date and
    time as strings.
    """
    payload = F.struct(
        F.col("symbol"), iso_timestamp(F.col("timestamp")).alias("timestamp"),
        F.col("open"), F.col("high"), F.col("low"), F.col("close"), F.col("volume"),
        F.col("date").cast("string").alias("date"), F.col("time").cast("string").alias("time"))
    return ticks.select(F.col("symbol").alias("key"), F.to_json(payload).alias("value"))


def decode_tick_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Keyed messages -> typed 7-column ticks plus ``_corrupt``.

    Only the seven table fields are declared, so extra fields are ignored
    and absent ones become NULL.  A volume may be written as a float (it is
    truncated) and a timestamp may end in ``Z``.  Text that is not JSON, and
    messages without a symbol or timestamp (tombstones, ``{}``), land in
    ``_corrupt`` (the row's other fields are NULL; a NULL value as the empty
    string) so callers can split them off.
    """
    text = F.col(value_col).cast("string")
    loose = StructType([StructField(f.name, DoubleType() if f.name == "volume" else StringType() if f.name == "timestamp" else f.dataType)
                        for f in TICK_MESSAGE_SCHEMA.fields])
    rec = F.from_json(text, loose, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    stamp = F.regexp_replace(F.col("r.timestamp"), r"(?:Z|[+]00:?00)$", "")
    stamp = F.when(stamp.rlike(ISO_PATTERN), F.regexp_replace(stamp, "T", " ").try_cast("timestamp_ntz"))
    volume = F.when(~F.isnan("r.volume"), F.col("r.volume")).try_cast("bigint")
    read = messages.select(text.alias("_text"), rec.alias("r")).withColumn("_stamp", stamp).withColumn("_volume", volume)
    bad = (F.col("r._corrupt").isNotNull() | F.col("r.symbol").isNull() | F.col("_stamp").isNull()
           | (F.col("r.volume").isNotNull() & F.col("_volume").isNull()))
    bad = F.coalesce(bad, F.lit(True))
    value = {"timestamp": F.col("_stamp"), "volume": F.col("_volume")}
    return read.select(*[F.when(~bad, value.get(f.name, F.col(f"r.{f.name}"))).alias(f.name)
                         for f in TICK_MESSAGE_SCHEMA.fields if f.name != "_corrupt"],
                       F.when(bad, F.coalesce("_text", F.lit(""))).alias("_corrupt"))


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good ticks without ``_corrupt``, rejects with the raw text)."""
    good = decoded.where(F.col("_corrupt").isNull()).drop("_corrupt")
    bad = decoded.where(F.col("_corrupt").isNotNull()).select(
        F.col("_corrupt").alias("raw"), F.lit("malformed").alias("reason"))
    return good, bad
