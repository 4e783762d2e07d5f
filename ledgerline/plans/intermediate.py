"""Intermediate models: pass-throughs, event filters, per-symbol averages,
the daily OHLCV rollup and the latest economic snapshot (all views)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators.rollup import daily_ohlcv
from ledgerline.operators.topk import latest_snapshot
from ledgerline.plans.registry import MODELS, Model, model

# Identity views over a staging model (model, parent, columns).
PASS_THROUGH = (
    ("int_test_commodity_prices", "stg_test_commodity_prices", "commodity date price"),
    ("int_test_fx_rates", "stg_test_fx_rates", "currency_pair date rate"),
    ("int_test_ratings", "stg_test_ratings", "symbol date rating rating_count"),
    ("int_test_sp500", "stg_test_sp500", "date open high low close volume"),
    ("int_test_vix", "stg_test_vix", "date implied_volatility"),
    ("int_test_volatility", "stg_test_volatility", "symbol date daily_return volatility beta"),
)


def _select_from(parent: str, cols: str):
    return lambda wh: wh.ref(parent).select(*cols.split())


for _name, _parent, _cols in PASS_THROUGH:
    MODELS[_name] = Model(_name, _select_from(_parent, _cols), "view", True, "intermediate")


# -- event filters ------------------------------------------------------------
@model("intermediate")
def int_test_dividends(wh):
    # NULL and NaN amounts are not events.  Spark orders NaN above every
    # number (NaN > 0 is true) while the warehouse treats it as false, so NaN
    # is excluded explicitly.
    amount = F.col("dividend_amount")
    return (wh.ref("stg_test_dividends")
            .select("symbol", "date", "dividend_amount", "dividend_yield")
            .where((amount > 0) & ~F.isnan(amount)))


@model("intermediate")
def int_test_earnings(wh):
    # a NaN is a missing figure of the loaded file, not an event
    actual = F.col("actual_eps")
    return (wh.ref("stg_test_earnings")
            .select("symbol", "date", "est_eps", "actual_eps", "surprise_pct")
            .where(actual.isNotNull() & ~F.isnan(actual)))


@model("intermediate")
def int_test_splits(wh):
    return (wh.ref("stg_test_splits")
            .select("symbol", "date", "split_ratio")
            .where(F.col("split_ratio") != 1.0))


# -- per-symbol averages ---------------------------------------------------
def _averages(parent: str, cols: str):
    def build(wh):
        return (wh.ref(parent).groupBy("symbol")
                .agg(*[F.avg(c).alias(f"avg_{c}") for c in cols.split()]))
    return build


for _name, _parent, _cols in (
        ("int_test_fundamentals", "stg_test_fundamentals", "eps pe_ratio market_cap"),
        ("int_test_sentiment", "stg_test_sentiment", "sentiment_score news_volume twitter_mentions"),
        ("int_test_technical_indicators", "stg_test_technical_indicators",
         "ma_10 ma_50 rsi macd bb_lower bb_upper")):
    MODELS[_name] = Model(_name, _averages(_parent, _cols), "view", True, "intermediate")


# -- rollups ------------------------------------------------------------------
@model("intermediate")
def int_daily_stock_summary(wh):
    """Daily OHLCV per (symbol, date).  Unordered: ordering is a presentation
    concern and no consumer relies on it."""
    ticks = wh.ref("stg_test_realtime_stock_data")
    return daily_ohlcv(ticks).select("symbol", "date", "open", "high", "low", "close", "volume")


@model("intermediate")
def int_test_economic_indicators(wh):
    """The most recent economic snapshot (0 or 1 row)."""
    return latest_snapshot(wh.ref("stg_test_economic_indicators"), "date",
                           ["inflation_rate", "unemployment_rate", "gdp_growth", "interest_rate"])
