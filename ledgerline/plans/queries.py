"""Named queries over a scale-factor directory: every model plus the
ingest, sink, streaming and quality operators, each as
``fn(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans.registry import MODELS
from ledgerline.session import apply_core_conf
from ledgerline.sources.catalog import Warehouse
from ledgerline.sources.fixtures import FixtureSources

Query = Callable[[SparkSession, str], DataFrame]

# The fixture economy table names countries NATION_0..NATION_24.
FIXTURE_PARAMS = {"economy_country": "NATION_0"}

# Average columns are compared rounded to 6 places (float summation order
# differs between engines); the models themselves return full precision.
ROUNDED = {
    "int_test_fundamentals": ("avg_eps", "avg_pe_ratio", "avg_market_cap"),
    "int_test_sentiment": ("avg_sentiment_score", "avg_news_volume", "avg_twitter_mentions"),
    "int_test_technical_indicators": ("avg_ma_10", "avg_ma_50", "avg_rsi", "avg_macd",
                                      "avg_bb_lower", "avg_bb_upper"),
    "crypto_daily_avg": ("crypto_avg_close",),
    "daily_stock_signals": ("crypto_avg_close",),
    "daily_stock_signals_enriched": ("crypto_avg_close",),
}
ROUNDED["stock_feature_mart"] = (ROUNDED["int_test_fundamentals"] + ROUNDED["int_test_sentiment"]
                                 + ROUNDED["int_test_technical_indicators"])


def fixture_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    apply_core_conf(spark)
    return Warehouse(spark, FixtureSources(spark, sf_dir), params=FIXTURE_PARAMS)


def rounded(df: DataFrame, cols) -> DataFrame:
    if not cols:
        return df
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fixture_warehouse(spark, sf_dir).ref(name), ROUNDED.get(name))
    run.__name__ = name
    return run


QUERIES: dict[str, Query] = {name: _model_query(name) for name in MODELS}


def query(name: str):
    """Register an operator query under ``name``."""
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# Operator queries register themselves on import.
from ledgerline.plans import operator_queries  # noqa: E402,F401
