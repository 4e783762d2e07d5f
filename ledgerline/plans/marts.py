"""Marts: the per-symbol feature mart and the daily signal tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import functions as F

from ledgerline.operators.topk import latest_per_key
from ledgerline.plans.registry import model

ECON_COLS = ("inflation_rate", "unemployment_rate", "gdp_growth", "interest_rate")


@model("marts", materialized="table")
def stock_feature_mart(wh):
    """One row per symbol that has ticks: its latest close/volume, the
    per-symbol averages, and the latest economic snapshot.

    All three average sides and the latest-tick side are aggregates keyed by
    ``symbol``, so the three left joins are co-partitioned (no extra
    exchange).  The economic snapshot is at most one row by construction; it
    is attached as a scalar subquery (evaluated once, inlined as a literal)
    rather than joined; a NULL snapshot filters every row out, keeping the rule
    that an empty snapshot yields an empty mart.
    """
    ticks = wh.ref("stg_test_realtime_stock_data")
    last_tick = (latest_per_key(ticks, "symbol", "timestamp", ["close", "volume"])
                 .select("symbol", F.col("close").alias("last_close"),
                         F.col("volume").alias("last_volume")))
    per_symbol = [wh.ref("int_test_fundamentals"), wh.ref("int_test_technical_indicators"),
                  wh.ref("int_test_sentiment")]
    snapshot = wh.ref("int_test_economic_indicators")
    # At most one row (the latest snapshot); its struct is NULL exactly when
    # the snapshot is empty.  More than one row would make Spark raise
    # instead of silently picking one.
    econ_row = snapshot.select(F.struct(*ECON_COLS).alias("s")).scalar()
    joined = last_tick
    for averages in per_symbol:
        joined = joined.join(averages, "symbol", "left")
    return (joined
            .withColumn("_econ", econ_row)
            .where(F.col("_econ").isNotNull())
            .select("symbol", "last_close", "last_volume",
                    "avg_eps", "avg_pe_ratio", "avg_market_cap",
                    "avg_ma_10", "avg_ma_50", "avg_rsi", "avg_macd", "avg_bb_lower", "avg_bb_upper",
                    "avg_sentiment_score", "avg_news_volume", "avg_twitter_mentions",
                    *[F.col("_econ").getField(c).alias(c) for c in ECON_COLS]))


def crypto_daily_avg(wh):
    """Average crypto close per calendar day (expression group key)."""
    return (wh.ref("stg_crypto_price_history")
            .groupBy(F.to_date("date").alias("date"))
            .agg(F.avg("close").alias("crypto_avg_close")))


def economy_for_country(wh):
    """Yearly GDP rows of one country (``economy_country`` parameter)."""
    country = wh.param("economy_country", "United States")
    return (wh.source("global_economy_indicators")
            .where(F.col("Country") == F.lit(country))
            .select(F.col("Year").alias("year"),
                    F.col("Gross_Domestic_Product_GDP").alias("gdp_per_capita")))


@dataclass(frozen=True)
class Side:
    """Columns that a daily mart takes from another table, and the keys that find its row."""

    rows: Callable
    keys: tuple[str, ...]
    columns: tuple[str, ...]


def _table(name: str, **renamed: str) -> Callable:
    return lambda wh: wh.ref(name).withColumnsRenamed(renamed)


# The (symbol, date) sides join the daily rows while these are still
# hash-partitioned on their keys by the rollup.  All others depend on the date
# alone: they are gathered per distinct date first, so the daily rows have one
# more join, on the date, whatever the number of such sides.
FEATURES = (
    Side(_table("stg_test_fundamentals"), ("symbol", "date"), ("eps", "pe_ratio", "market_cap", "sector")),
    Side(_table("stg_test_technical_indicators"), ("symbol", "date"), ("ma_10", "ma_50", "rsi", "macd", "bb_lower", "bb_upper")),
    Side(_table("stg_test_sentiment"), ("symbol", "date"), ("sentiment_score", "news_volume", "twitter_mentions")),
)
MARKET = (
    Side(_table("stg_sandp500_data", close="sp500_close"), ("date",), ("sp500_close",)),
    Side(crypto_daily_avg, ("date",), ("crypto_avg_close",)),
    Side(economy_for_country, ("year",), ("gdp_per_capita",)),
)
MACRO = (Side(_table("stg_test_economic_indicators"), ("date",), ECON_COLS),)


def _calendar(wh, daily, sides: list[Side]):
    """The sides' columns for every date of the daily rows (several rows where a side has several).

    The yearly side meets the distinct dates, which are broadcast: there are no
    more of them than days in the calendar (four bytes each), however many
    rows the daily table has.  Nothing is ever shuffled by year.
    """
    dates = daily.where(F.col("date").isNotNull()).select("date").distinct()
    rows = dates
    for side in sides:
        found = side.rows(wh).select(*side.keys, *side.columns)
        if side.keys == ("year",):
            on = F.year("date") == F.col("year")
            found = F.broadcast(dates).join(found, on).select("date", *side.columns)
        rows = rows.join(found, "date", "left")
    return rows


def _with_sides(wh, joins: tuple[Side, ...], columns: tuple[Side, ...]):
    """Every daily row with the sides' columns (NULL where a side has no row)."""
    daily = wh.ref("int_daily_stock_summary")
    shown = [*daily.columns, *[c for side in columns for c in side.columns]]
    rows = daily
    for side in joins:
        if "symbol" in side.keys:
            rows = rows.join(side.rows(wh).select(*side.keys, *side.columns), list(side.keys), "left")
    dated = [side for side in joins if "symbol" not in side.keys]
    return rows.join(_calendar(wh, daily, dated), "date", "left").select(*shown)


@model("marts", materialized="table", enabled=False)
def daily_stock_signals(wh):
    """Daily summary with the S&P close, the crypto daily average and the
    year's GDP of one country."""
    return _with_sides(wh, MARKET, MARKET)


@model("marts", materialized="table", enabled=False)
def daily_stock_signals_enriched(wh):
    """Daily summary with market, per-(symbol, date) and macro features."""
    return _with_sides(wh, FEATURES + MARKET + MACRO, MARKET + FEATURES + MACRO)
