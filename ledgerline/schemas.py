"""Explicit schemas of the raw tables and message payloads."""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

# All timestamps are naive wall-clock values (the sources record local time
# without a zone), so they are TIMESTAMP_NTZ end to end.
TS = TimestampNTZType()


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# The 7-column tick table written by the pollers and the topic consumer.
TICK_SCHEMA = _struct(
    ("symbol", StringType()), ("timestamp", TS), ("open", DoubleType()),
    ("high", DoubleType()), ("low", DoubleType()), ("close", DoubleType()),
    ("volume", LongType()))

# The 9-column tick table (7 columns + date/time split).
TICK_SPLIT_SCHEMA = _struct(
    ("symbol", StringType()), ("timestamp", TS), ("date", DateType()),
    ("time", StringType()), ("open", DoubleType()), ("high", DoubleType()),
    ("low", DoubleType()), ("close", DoubleType()), ("volume", LongType()))

# Payload of one topic message.  Only the seven table fields are declared, so
# extra fields are ignored and absent ones become NULL; ``_corrupt`` receives
# the raw text of a message that is not valid JSON.
TICK_MESSAGE_SCHEMA = _struct(
    ("symbol", StringType()), ("timestamp", TS), ("open", DoubleType()),
    ("high", DoubleType()), ("low", DoubleType()), ("close", DoubleType()),
    ("volume", LongType()), ("_corrupt", StringType()))

RAW_TABLES = (
    "realtime_test_stock_data", "streaming_stock_data", "test_fundamentals",
    "test_technical_indicators", "test_sentiment", "test_economic_indicators",
    "test_dividends", "test_splits", "test_earnings", "test_volatility",
    "test_ratings", "test_sp500", "test_vix", "test_fx_rates",
    "test_commodity_prices", "sandp500_data", "crypto_price_history",
    "global_economy_indicators",
)

_DAY, _NUM, _INT, _STR = TimestampNTZType(), DoubleType(), LongType(), StringType()

# Declared types of the loaded tables whose loaders give text, NaN or whole
# timestamps (see ``sources.typed``).
RAW_TYPES = {
    "test_fundamentals": _struct(("symbol", _STR), ("date", _DAY), ("eps", _NUM), ("pe_ratio", _NUM),
                                 ("market_cap", _INT), ("sector", _STR)),
    "test_technical_indicators": _struct(("symbol", _STR), ("date", _DAY), ("ma_10", _NUM), ("ma_50", _NUM),
                                         ("rsi", _NUM), ("macd", _NUM), ("bb_lower", _NUM), ("bb_upper", _NUM)),
    "test_sentiment": _struct(("symbol", _STR), ("date", _DAY), ("sentiment_score", _NUM),
                              ("news_volume", _INT), ("twitter_mentions", _INT)),
    "test_economic_indicators": _struct(("date", _DAY), ("inflation_rate", _NUM), ("unemployment_rate", _NUM),
                                        ("gdp_growth", _NUM), ("interest_rate", _NUM)),
    "test_dividends": _struct(("symbol", _STR), ("date", _DAY), ("dividend_amount", _NUM), ("dividend_yield", _NUM)),
    "test_splits": _struct(("symbol", _STR), ("date", _DAY), ("split_ratio", _NUM)),
    "test_earnings": _struct(("symbol", _STR), ("date", _DAY), ("est_eps", _NUM), ("actual_eps", _NUM),
                             ("surprise_pct", _NUM)),
    "sandp500_data": _struct(("Date", DateType()), ("Open", _NUM), ("High", _NUM), ("Low", _NUM), ("Close", _NUM),
                             ("Volume", _INT)),
}
