"""Daily open/high/low/close/volume rollup of intraday ticks."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.timecols import naive_epoch_micros

# Ordering key used for "first" / "last" within a day.  The ``time`` column is
# always the HH:mm:ss split of ``timestamp`` and ``date`` its calendar day, so
# inside one (symbol, date) group ordering by ``time`` equals ordering by
# ``timestamp``.  Ticks of one timestamp are told apart by a tie: an id of the
# row where the caller has one, else a hash of its values, so the result does
# not depend on how the rows are partitioned.  Both parts make one DECIMAL
# (microseconds * 2^64 + tie): a fixed-width key keeps min_by/max_by in
# HashAggregate (a struct key forces SortAggregate, i.e. a local sort of every
# raw tick).  Rows without a timestamp sort first, like NULLs in an ascending
# window order.  Naive timestamps are counted without the session time zone,
# so the order never depends on it.
_NULL_FIRST = -(10 ** 18)
_WHOLE = "decimal(20,0)"


def tick_order_key(tie: Column, ts_col: str = "timestamp", naive: bool = True) -> Column:
    """Order of (timestamp, tie); ``tie`` is a BIGINT, null ones first."""
    ts = F.col(ts_col)
    micros = naive_epoch_micros(ts) if naive else F.unix_micros(ts)
    micros = F.coalesce(micros, F.lit(_NULL_FIRST)).cast(_WHOLE)
    tie = F.coalesce(tie.cast("bigint"), F.lit(-(2 ** 63)))
    return micros * F.lit(Decimal(2 ** 64)) + tie.cast(_WHOLE)


def row_tie(*cols: str) -> Column:
    """A tie from the row's values: rows of one tie are equal in ``cols`` (but for a 64-bit collision
    between rows of one timestamp)."""
    return F.xxhash64(*cols)


def ohlcv_order_key(ticks: DataFrame, ts_col: str = "timestamp", tie: str | None = None) -> Column:
    naive = ticks.schema[ts_col].dataType.typeName() == "timestamp_ntz"
    return tick_order_key(F.col(tie) if tie else row_tie("open", "high", "low", "close", "volume"), ts_col, naive)


def ohlcv_aggregates(ticks: DataFrame, ts_col: str = "timestamp", tie: str | None = None) -> list[Column]:
    """The five OHLCV aggregates (first open, max high, min low, last close,
    total volume); shared by the batch rollup and the streaming one."""
    ord_key = ohlcv_order_key(ticks, ts_col, tie)
    return [F.min_by("open", ord_key).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", ord_key).alias("close"),
            F.sum("volume").alias("volume")]


def daily_ohlcv(ticks: DataFrame, keys: tuple[str, ...] = ("symbol", "date"),
                ts_col: str = "timestamp", tie: str | None = None) -> DataFrame:
    """One row per (symbol, date): first open, max high, min low, last close,
    total volume.  ``tie`` names a BIGINT column that orders ticks of one
    timestamp (default: a hash of the tick's values).

    Plan: partial HashAggregate on the map side (one row per group per input
    partition), one shuffle on the keys, final HashAggregate.  A symbol
    holding a third of all ticks therefore ships only one partial row per
    (date, map task) — the hot key never lands whole in one task.
    """
    return ticks.groupBy(*keys).agg(*ohlcv_aggregates(ticks, ts_col, tie))
