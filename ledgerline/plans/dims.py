"""Dimension models (tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.plans.registry import model


@model("dimensions", materialized="table")
def date_dim(wh):
    """Contiguous calendar between the first and last economic date.

    The bounds are one global min/max aggregate (partial per task); the
    calendar is generated from that single row, so its size is the number of
    days in the range, independent of the input row count.  NULL bounds give
    no rows.
    """
    bounds = wh.ref("stg_test_economic_indicators").agg(
        F.min("date").alias("min_date"), F.max("date").alias("max_date"))
    days = bounds.select(F.explode(F.sequence("min_date", "max_date")).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.dayofweek("date").alias("weekday"),  # 1 = Sunday .. 7 = Saturday
    )


@model("dimensions", materialized="table")
def dim_stock(wh):
    # any_value ignoring NULLs, as the warehouse's ANY_VALUE does.
    return (wh.ref("stg_test_fundamentals").groupBy("symbol")
            .agg(F.any_value("sector", ignoreNulls=True).alias("sector")))
