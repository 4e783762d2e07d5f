"""Staging models: one projection per raw table (all views).

Four tables carry a datetime ``date`` that the model narrows to a DATE; the
other nine pass their ``date`` through unchanged.  The three CSV-landed
tables rename their capitalised headers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.plans.registry import MODELS, Model

# The staging models (model, raw table, columns, columns cast
# with date(), enabled), in the warehouse's naming.  A column entry "a:b"
# selects raw column ``a`` as ``b``.
STAGING = (
    ("stg_test_realtime_stock_data", "realtime_test_stock_data",
     "symbol timestamp date time open high low close volume", (), True),
    ("stg_streaming_stock_data", "streaming_stock_data",
     "symbol timestamp open high low close volume", (), False),
    ("stg_test_fundamentals", "test_fundamentals",
     "symbol date eps pe_ratio market_cap sector", ("date",), True),
    ("stg_test_technical_indicators", "test_technical_indicators",
     "symbol date ma_10 ma_50 rsi macd bb_lower bb_upper", ("date",), True),
    ("stg_test_sentiment", "test_sentiment",
     "symbol date sentiment_score news_volume twitter_mentions", ("date",), True),
    ("stg_test_economic_indicators", "test_economic_indicators",
     "date inflation_rate unemployment_rate gdp_growth interest_rate", ("date",), True),
    ("stg_test_dividends", "test_dividends", "symbol date dividend_amount dividend_yield", (), True),
    ("stg_test_splits", "test_splits", "symbol date split_ratio", (), True),
    ("stg_test_earnings", "test_earnings", "symbol date est_eps actual_eps surprise_pct", (), True),
    ("stg_test_ratings", "test_ratings", "symbol date rating rating_count", (), True),
    ("stg_test_volatility", "test_volatility", "symbol date daily_return volatility beta", (), True),
    ("stg_test_sp500", "test_sp500", "date open high low close volume", (), True),
    ("stg_test_vix", "test_vix", "date implied_volatility", (), True),
    ("stg_test_fx_rates", "test_fx_rates", "currency_pair date rate", (), True),
    ("stg_test_commodity_prices", "test_commodity_prices", "commodity date price", (), True),
    ("stg_sandp500_data", "sandp500_data",
     "Date:date Open:open High:high Low:low Close:close Volume:volume", (), False),
    ("stg_crypto_price_history", "crypto_price_history",
     "Date:date Symbol:symbol Open:open High:high Low:low Close:close Volume:volume", (), False),
    ("stg_global_economy_indicators", "global_economy_indicators", "*", (), False),
)


def _staging_model(raw: str, cols: str, date_cols: tuple[str, ...]):
    def build(wh):
        df = wh.source(raw)
        if cols == "*":
            return df
        out = []
        for spec in cols.split():
            src, _, dst = spec.partition(":")
            dst = dst or src
            c = F.to_date(F.col(src)) if src in date_cols else F.col(src)
            out.append(c.alias(dst))
        return df.select(*out)
    return build


for _name, _raw, _cols, _dates, _enabled in STAGING:
    MODELS[_name] = Model(_name, _staging_model(_raw, _cols, _dates), "view", _enabled, "staging")
