"""Fact models (materialised as tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.plans.registry import MODELS, Model, model

# Fact tables that select from one model (fact, parent, columns).
PASS_THROUGH = (
    ("fact_commodity_prices", "int_test_commodity_prices", "commodity date price"),
    ("fact_fx_rates", "int_test_fx_rates", "currency_pair date rate"),
    ("fact_ratings", "int_test_ratings", "symbol date rating rating_count"),
    ("fact_sp500", "int_test_sp500", "date open high low close volume"),
    ("fact_vix", "int_test_vix", "date implied_volatility"),
    ("fact_volatility", "int_test_volatility", "symbol date daily_return volatility beta"),
    ("fact_dividends", "int_test_dividends", "symbol date dividend_amount dividend_yield"),
    ("fact_earnings", "int_test_earnings", "symbol date est_eps actual_eps surprise_pct"),
    ("fact_splits", "int_test_splits", "symbol date split_ratio"),
    ("fact_daily_summary", "int_daily_stock_summary", "symbol date open high low close volume"),
)

for _name, _parent, _cols in PASS_THROUGH:
    MODELS[_name] = Model(_name, (lambda p, c: lambda wh: wh.ref(p).select(*c.split()))(_parent, _cols),
                          "table", True, "facts")


@model("facts", materialized="table")
def fact_stock_tick(wh):
    # ``date`` is recomputed from the timestamp, not taken from the stored column.
    return wh.ref("stg_test_realtime_stock_data").select(
        "symbol", "timestamp", F.to_date("timestamp").alias("date"),
        "open", "high", "low", "close", "volume")


@model("facts", materialized="table")
def fact_daily_features(wh):
    """Fundamentals ⟕ technical ⟕ sentiment on (symbol, date), ⟕ economics on date.

    The (symbol, date) joins shuffle each side once on (symbol, date), or
    broadcast a side that Catalyst estimates small; after that all three
    share the partitioning, so the chain adds no further exchange.  The
    date-keyed economics side has one row per date; AQE turns that join into
    a broadcast once the runtime size is known, and falls back to a
    sort-merge join when it is not small.
    """
    fundamentals = wh.ref("stg_test_fundamentals")
    technical = wh.ref("stg_test_technical_indicators")
    sentiment = wh.ref("stg_test_sentiment")
    macro = wh.ref("stg_test_economic_indicators")
    return (fundamentals.join(technical, ["symbol", "date"], "left")
            .join(sentiment, ["symbol", "date"], "left")
            .join(macro, ["date"], "left")
            .select("symbol", "date", "eps", "pe_ratio", "market_cap", "sector",
                    "ma_10", "ma_50", "rsi", "macd", "bb_lower", "bb_upper",
                    "sentiment_score", "news_volume", "twitter_mentions",
                    "inflation_rate", "unemployment_rate", "gdp_growth", "interest_rate"))
