"""Latest-row and top-N selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: str | Column,
                   cols: Sequence[str], tie: str | None = None) -> DataFrame:
    """For each key, the ``cols`` of the row with the greatest ``order``.

    Rows of one timestamp are ordered by the BIGINT column ``tie``, or without
    one by a hash of ``cols``, so the row does not depend on the partitioning.

    One ``max_by(col, order)`` per column: with a fixed-width ``order`` the
    aggregate stays a HashAggregate with a map-side partial step, so a hot
    key costs one candidate row per map task in the shuffle instead of a
    sort of all its rows.  All ``max_by`` calls see the rows in the same order
    with the same comparison, so they pick the same row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if isinstance(order, str) and df.schema[order].dataType.typeName() in ("timestamp", "timestamp_ntz"):
        # NULL timestamps rank lowest (DESC ... NULLS LAST), so a key whose
        # rows all lack a timestamp still yields one of its rows.
        from ledgerline.operators.rollup import row_tie, tick_order_key
        order_c = tick_order_key(F.col(tie) if tie else row_tie(*cols), order, df.schema[order].dataType.typeName() == "timestamp_ntz")
    else:
        order_c = F.col(order) if isinstance(order, str) else order
    return (df.groupBy(*keys)
            .agg(*[F.max_by(c, order_c).alias(c) for c in cols]))


def latest_snapshot(df: DataFrame, order: str, cols: Sequence[str]) -> DataFrame:
    """The single row with the greatest ``order`` (``row_number() over (order
    by order desc) = 1``).  ``orderBy(...).limit(1)`` plans as a distributed
    top-1 (TakeOrderedAndProject): each task keeps one candidate."""
    return df.orderBy(F.col(order).desc_nulls_last()).limit(1).select(*cols)


def newest_rows(df: DataFrame, n: int, order: str = "timestamp",
                tie: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows overall (a top-k report; the limit is the
    feature), ties by the columns ``tie``, by default all others.  Plans as
    TakeOrderedAndProject: per-task top-n, then merge."""
    return df.orderBy(F.col(order).desc_nulls_last(), *_ties(df, tie, order)).limit(n)


def _ties(df: DataFrame, tie: Sequence[str], *used: str) -> list[Column]:
    """Ascending tie columns; by default every other column that has an order."""
    names = tie or [f.name for f in df.schema.fields
                    if f.name not in used and f.dataType.typeName() not in ("map", "variant")]
    return [F.col(t).asc() for t in names]


def newest_per_key(df: DataFrame, key: str | Sequence[str], n: int,
                   order: str = "timestamp", tie: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows of every key, ties by the columns ``tie``, by
    default all others.

    ``row_number() <= n`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so each map task forwards at most ``n`` rows per key;
    a hot key reaches its reducer as n × (map tasks) rows, not whole.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), *_ties(df, tie, order, *keys))
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= n).drop("_rn"))
