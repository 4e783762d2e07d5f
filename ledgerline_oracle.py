"""DuckDB oracle SQL for every registered query.

Each query is a final SELECT over named CTEs; ``compose`` prepends the CTEs
it (transitively) mentions.  The raw-table CTEs mirror
``ledgerline.sources.fixtures`` and the model CTEs restate each model in
plain DuckDB SQL of another shape than the engine's: first/last rows as
windows, the daily marts' side values as one lookup per key, latest snapshots
as ``ORDER BY ... LIMIT``.

Oracle rules: integer sums are cast to BIGINT (DuckDB returns HUGEINT);
averages are rounded to 6 places on both sides; DuckDB's dayofweek is
0-based; date parts are cast to INTEGER; NULL order is spelled out.
"""

from __future__ import annotations

import re

CTE: dict[str, str] = {}

# --------------------------------------------------------------------------
# raw tables derived from the driver tables
CTE["ev"] = """
  SELECT event_id, event_type, value, ts,
         'NATION_' || CAST(user_id % 25 AS VARCHAR) AS symbol,
         CAST(user_id % 25 AS INTEGER) AS nationkey,
         CAST(ts AS DATE) AS d,
         TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
  FROM events"""
CTE["realtime_test_stock_data"] = """
  SELECT symbol, ts AS timestamp, d AS date, strftime(ts, '%H:%M:%S') AS time,
         value AS open, value + CAST(1.0 AS DOUBLE) AS high, value - CAST(1.0 AS DOUBLE) AS low,
         value + CAST(0.25 AS DOUBLE) AS close, k AS volume, event_id
  FROM ev"""
CTE["streaming_stock_data"] = """
  SELECT symbol, timestamp, open, high, low, close, volume FROM realtime_test_stock_data"""
CTE["test_fundamentals"] = """
  SELECT e.symbol, CAST(e.d AS TIMESTAMP) AS date, max(e.value) AS eps, min(e.value) AS pe_ratio,
         CAST(sum(e.k) AS BIGINT) AS market_cap, r.r_name AS sector
  FROM ev e JOIN nation n ON e.nationkey = n.n_nationkey
            JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE e.event_type = 'purchase'
  GROUP BY e.symbol, e.d, r.r_name"""
CTE["test_technical_indicators"] = """
  SELECT symbol, CAST(d AS TIMESTAMP) AS date, max(value) AS ma_10, min(value) AS ma_50,
         CAST(max(k) AS DOUBLE) AS rsi, CAST(min(k) AS DOUBLE) AS macd,
         min(value) - CAST(1.0 AS DOUBLE) AS bb_lower, max(value) + CAST(1.0 AS DOUBLE) AS bb_upper
  FROM ev WHERE event_type = 'view' GROUP BY symbol, d"""
CTE["test_sentiment"] = """
  SELECT symbol, CAST(d AS TIMESTAMP) AS date, max(value) AS sentiment_score,
         count(*) AS news_volume, CAST(sum(k) AS BIGINT) AS twitter_mentions
  FROM ev WHERE event_type = 'click' GROUP BY symbol, d"""
CTE["test_economic_indicators"] = """
  SELECT CAST(d AS TIMESTAMP) AS date, min(value) AS inflation_rate, max(value) AS unemployment_rate,
         CAST(min(k) AS DOUBLE) AS gdp_growth, CAST(max(k) AS DOUBLE) AS interest_rate
  FROM ev WHERE event_type = 'signup' GROUP BY d"""
CTE["test_dividends"] = """
  SELECT symbol, ts AS date,
         CASE WHEN k % 50 = 0 THEN value ELSE CAST(0.0 AS DOUBLE) END AS dividend_amount,
         CAST(k AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS dividend_yield
  FROM ev WHERE event_type = 'purchase'"""
CTE["test_splits"] = """
  SELECT symbol, ts AS date,
         CAST(CASE k WHEN 10 THEN 2.0 WHEN 20 THEN 3.0 WHEN 30 THEN 1.5 WHEN 40 THEN 0.5
                     ELSE 1.0 END AS DOUBLE) AS split_ratio
  FROM ev WHERE event_type = 'purchase'"""
CTE["test_earnings"] = """
  SELECT symbol, ts AS date,
         CASE WHEN k < 5 THEN value END AS est_eps,
         CASE WHEN k < 5 THEN value END + CAST(0.25 AS DOUBLE) AS actual_eps,
         CASE WHEN k < 5 THEN CAST(k AS DOUBLE) END AS surprise_pct
  FROM ev WHERE event_type = 'error'"""
CTE["test_volatility"] = """
  SELECT symbol, ts AS date, value AS daily_return, value + CAST(1.0 AS DOUBLE) AS volatility,
         CAST(k AS DOUBLE) AS beta
  FROM ev WHERE event_type = 'error'"""
CTE["test_ratings"] = """
  SELECT symbol, ts AS date, k % 5 + 1 AS rating, k AS rating_count
  FROM ev WHERE event_type = 'view'"""
CTE["index_daily"] = """
  SELECT d, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, CAST(sum(k) AS BIGINT) AS volume
  FROM ev WHERE event_type = 'error' GROUP BY d"""
CTE["test_sp500"] = """
  SELECT CAST(d AS TIMESTAMP) AS date, open, high, low, close, volume FROM index_daily"""
CTE["test_vix"] = """
  SELECT CAST(d AS TIMESTAMP) AS date, max(value) AS implied_volatility
  FROM ev WHERE event_type = 'error' GROUP BY d"""
CTE["test_fx_rates"] = """
  SELECT event_type AS currency_pair, CAST(d AS TIMESTAMP) AS date, max(value) AS rate
  FROM ev GROUP BY event_type, d"""
CTE["test_commodity_prices"] = """
  SELECT CASE WHEN event_type = 'view' THEN 'Gold' ELSE 'Oil' END AS commodity,
         CAST(d AS TIMESTAMP) AS date, max(value) AS price
  FROM ev WHERE event_type IN ('view', 'click') GROUP BY event_type, d"""
CTE["sandp500_data"] = """
  SELECT d AS "Date", open AS "Open", high AS "High", low AS "Low", close AS "Close",
         volume AS "Volume"
  FROM index_daily"""
CTE["crypto_price_history"] = """
  SELECT ts AS "Date", symbol AS "Symbol", value AS "Open", value + CAST(1.0 AS DOUBLE) AS "High",
         value - CAST(1.0 AS DOUBLE) AS "Low", value + CAST(0.25 AS DOUBLE) AS "Close", k AS "Volume"
  FROM ev WHERE event_type = 'error'"""
CTE["global_economy_indicators"] = """
  SELECT CAST(year(o.o_orderdate) + 25 AS INTEGER) AS "Year", n.n_name AS "Country",
         max(o.o_totalprice) AS "Gross_Domestic_Product_GDP"
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2"""

# --------------------------------------------------------------------------
# staging
STAGING_SQL = {
    "stg_test_realtime_stock_data": ("realtime_test_stock_data",
                                     "symbol, timestamp, date, time, open, high, low, close, volume"),
    "stg_streaming_stock_data": ("streaming_stock_data",
                                 "symbol, timestamp, open, high, low, close, volume"),
    "stg_test_fundamentals": ("test_fundamentals",
                              "symbol, CAST(date AS DATE) AS date, eps, pe_ratio, market_cap, sector"),
    "stg_test_technical_indicators": ("test_technical_indicators",
                                      "symbol, CAST(date AS DATE) AS date, ma_10, ma_50, rsi, macd, bb_lower, bb_upper"),
    "stg_test_sentiment": ("test_sentiment",
                           "symbol, CAST(date AS DATE) AS date, sentiment_score, news_volume, twitter_mentions"),
    "stg_test_economic_indicators": ("test_economic_indicators",
                                     "CAST(date AS DATE) AS date, inflation_rate, unemployment_rate, gdp_growth, interest_rate"),
    "stg_test_dividends": ("test_dividends", "symbol, date, dividend_amount, dividend_yield"),
    "stg_test_splits": ("test_splits", "symbol, date, split_ratio"),
    "stg_test_earnings": ("test_earnings", "symbol, date, est_eps, actual_eps, surprise_pct"),
    "stg_test_ratings": ("test_ratings", "symbol, date, rating, rating_count"),
    "stg_test_volatility": ("test_volatility", "symbol, date, daily_return, volatility, beta"),
    "stg_test_sp500": ("test_sp500", "date, open, high, low, close, volume"),
    "stg_test_vix": ("test_vix", "date, implied_volatility"),
    "stg_test_fx_rates": ("test_fx_rates", "currency_pair, date, rate"),
    "stg_test_commodity_prices": ("test_commodity_prices", "commodity, date, price"),
    "stg_sandp500_data": ("sandp500_data",
                          '"Date" AS date, "Open" AS open, "High" AS high, "Low" AS low, '
                          '"Close" AS close, "Volume" AS volume'),
    "stg_crypto_price_history": ("crypto_price_history",
                                 '"Date" AS date, "Symbol" AS symbol, "Open" AS open, "High" AS high, '
                                 '"Low" AS low, "Close" AS close, "Volume" AS volume'),
    "stg_global_economy_indicators": ("global_economy_indicators", "*"),
}
for _m, (_raw, _cols) in STAGING_SQL.items():
    CTE[_m] = f"SELECT {_cols} FROM {_raw}"

# intermediate
for _m, _p, _cols in (
        ("int_test_commodity_prices", "stg_test_commodity_prices", "commodity, date, price"),
        ("int_test_fx_rates", "stg_test_fx_rates", "currency_pair, date, rate"),
        ("int_test_ratings", "stg_test_ratings", "symbol, date, rating, rating_count"),
        ("int_test_sp500", "stg_test_sp500", "date, open, high, low, close, volume"),
        ("int_test_vix", "stg_test_vix", "date, implied_volatility"),
        ("int_test_volatility", "stg_test_volatility", "symbol, date, daily_return, volatility, beta")):
    CTE[_m] = f"SELECT {_cols} FROM {_p}"
CTE["int_test_dividends"] = """
  SELECT symbol, date, dividend_amount, dividend_yield FROM stg_test_dividends
  WHERE dividend_amount > 0"""
CTE["int_test_earnings"] = """
  SELECT symbol, date, est_eps, actual_eps, surprise_pct FROM stg_test_earnings
  WHERE actual_eps IS NOT NULL"""
CTE["int_test_splits"] = """
  SELECT symbol, date, split_ratio FROM stg_test_splits WHERE split_ratio != 1.0"""
CTE["int_test_fundamentals"] = """
  SELECT symbol, avg(eps) AS avg_eps, avg(pe_ratio) AS avg_pe_ratio, avg(market_cap) AS avg_market_cap
  FROM stg_test_fundamentals GROUP BY symbol"""
CTE["int_test_sentiment"] = """
  SELECT symbol, avg(sentiment_score) AS avg_sentiment_score, avg(news_volume) AS avg_news_volume,
         avg(twitter_mentions) AS avg_twitter_mentions
  FROM stg_test_sentiment GROUP BY symbol"""
CTE["int_test_technical_indicators"] = """
  SELECT symbol, avg(ma_10) AS avg_ma_10, avg(ma_50) AS avg_ma_50, avg(rsi) AS avg_rsi,
         avg(macd) AS avg_macd, avg(bb_lower) AS avg_bb_lower, avg(bb_upper) AS avg_bb_upper
  FROM stg_test_technical_indicators GROUP BY symbol"""
# First / last of a day by (time, timestamp) with NULLs first, in window form.
CTE["int_daily_stock_summary"] = """
  SELECT DISTINCT symbol, date,
         first_value(open) OVER in_order AS open, max(high) OVER whole AS high, min(low) OVER whole AS low,
         last_value(close) OVER in_order AS close, CAST(sum(volume) OVER whole AS BIGINT) AS volume
  FROM stg_test_realtime_stock_data
  WINDOW whole AS (PARTITION BY symbol, date),
         in_order AS (PARTITION BY symbol, date ORDER BY time NULLS FIRST, timestamp NULLS FIRST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""
CTE["int_test_economic_indicators"] = """
  SELECT inflation_rate, unemployment_rate, gdp_growth, interest_rate
  FROM stg_test_economic_indicators
  ORDER BY date DESC NULLS LAST
  LIMIT 1"""

# facts
for _m, _p, _cols in (
        ("fact_commodity_prices", "int_test_commodity_prices", "commodity, date, price"),
        ("fact_fx_rates", "int_test_fx_rates", "currency_pair, date, rate"),
        ("fact_ratings", "int_test_ratings", "symbol, date, rating, rating_count"),
        ("fact_sp500", "int_test_sp500", "date, open, high, low, close, volume"),
        ("fact_vix", "int_test_vix", "date, implied_volatility"),
        ("fact_volatility", "int_test_volatility", "symbol, date, daily_return, volatility, beta"),
        ("fact_dividends", "int_test_dividends", "symbol, date, dividend_amount, dividend_yield"),
        ("fact_earnings", "int_test_earnings", "symbol, date, est_eps, actual_eps, surprise_pct"),
        ("fact_splits", "int_test_splits", "symbol, date, split_ratio"),
        ("fact_daily_summary", "int_daily_stock_summary", "symbol, date, open, high, low, close, volume")):
    CTE[_m] = f"SELECT {_cols} FROM {_p}"
CTE["fact_stock_tick"] = """
  SELECT symbol, timestamp, CAST(timestamp AS DATE) AS date, open, high, low, close, volume
  FROM stg_test_realtime_stock_data"""
CTE["fact_daily_features"] = """
  SELECT fnd.symbol, fnd.date, fnd.eps, fnd.pe_ratio, fnd.market_cap, fnd.sector,
         tec.ma_10, tec.ma_50, tec.rsi, tec.macd, tec.bb_lower, tec.bb_upper,
         snt.sentiment_score, snt.news_volume, snt.twitter_mentions,
         mac.inflation_rate, mac.unemployment_rate, mac.gdp_growth, mac.interest_rate
  FROM stg_test_fundamentals fnd
  LEFT JOIN stg_test_economic_indicators mac ON mac.date = fnd.date
  LEFT JOIN stg_test_sentiment snt ON (snt.symbol, snt.date) = (fnd.symbol, fnd.date)
  LEFT JOIN stg_test_technical_indicators tec ON (tec.symbol, tec.date) = (fnd.symbol, fnd.date)"""

# dimensions
CTE["date_dim"] = """
  SELECT CAST(g.dt AS DATE) AS date,
         CAST(year(g.dt) AS INTEGER) AS year,
         CAST(month(g.dt) AS INTEGER) AS month,
         CAST(day(g.dt) AS INTEGER) AS day,
         CAST(dayofweek(g.dt) + 1 AS INTEGER) AS weekday
  FROM (SELECT min(date) AS min_date, max(date) AS max_date FROM stg_test_economic_indicators) b,
       generate_series(b.min_date, b.max_date, INTERVAL 1 DAY) AS g(dt)"""
CTE["dim_stock"] = """
  SELECT symbol, any_value(sector) AS sector FROM stg_test_fundamentals GROUP BY symbol"""

# marts
# Latest tick per symbol: greatest timestamp, NULL timestamps lowest.
CTE["latest_ticks"] = """
  SELECT symbol, timestamp, close AS last_close, volume AS last_volume
  FROM stg_test_realtime_stock_data
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC NULLS LAST) = 1"""
CTE["stock_feature_mart"] = """
  SELECT l.symbol, l.last_close, l.last_volume,
         f.avg_eps, f.avg_pe_ratio, f.avg_market_cap,
         t.avg_ma_10, t.avg_ma_50, t.avg_rsi, t.avg_macd, t.avg_bb_lower, t.avg_bb_upper,
         s.avg_sentiment_score, s.avg_news_volume, s.avg_twitter_mentions,
         e.inflation_rate, e.unemployment_rate, e.gdp_growth, e.interest_rate
  FROM latest_ticks l
  JOIN int_test_economic_indicators e ON TRUE
  LEFT JOIN int_test_fundamentals f USING (symbol)
  LEFT JOIN int_test_technical_indicators t USING (symbol)
  LEFT JOIN int_test_sentiment s USING (symbol)"""
CTE["crypto_daily_avg"] = """
  SELECT CAST(date AS DATE) AS date, avg(close) AS crypto_avg_close
  FROM stg_crypto_price_history GROUP BY CAST(date AS DATE)"""
CTE["economy_fixture"] = """
  SELECT "Year" AS year, "Gross_Domestic_Product_GDP" AS gdp_per_capita
  FROM global_economy_indicators WHERE "Country" = 'NATION_0'"""


def _lookups(table: str, cols: str, *keys: str) -> str:
    """One scalar lookup per column: its value in ``table`` at the daily row's keys."""
    at = " AND ".join(f"x.{k} = day.{k}" for k in keys)
    return ", ".join(f"(SELECT x.{c.strip()} FROM {table} x WHERE {at}) AS {c.strip()}" for c in cols.split(","))


_MARKET = """(SELECT x.close FROM stg_sandp500_data x WHERE x.date = day.date) AS sp500_close,
         (SELECT x.crypto_avg_close FROM crypto_daily_avg x WHERE x.date = day.date) AS crypto_avg_close,
         (SELECT x.gdp_per_capita FROM economy_fixture x WHERE x.year = CAST(year(day.date) AS INTEGER)) AS gdp_per_capita"""
CTE["daily_stock_signals"] = f"SELECT day.*, {_MARKET} FROM int_daily_stock_summary day"
CTE["daily_stock_signals_enriched"] = f"""
  SELECT day.*, {_MARKET},
         {_lookups("stg_test_fundamentals", "eps, pe_ratio, market_cap, sector", "symbol", "date")},
         {_lookups("stg_test_technical_indicators", "ma_10, ma_50, rsi, macd, bb_lower, bb_upper", "symbol", "date")},
         {_lookups("stg_test_sentiment", "sentiment_score, news_volume, twitter_mentions", "symbol", "date")},
         {_lookups("stg_test_economic_indicators", "inflation_rate, unemployment_rate, gdp_growth, interest_rate", "date")}
  FROM int_daily_stock_summary day"""

# Columns holding floating-point averages: rounded to 6 places on both sides.
from ledgerline.plans.queries import ROUNDED  # noqa: E402

MODEL_QUERIES = [n for n in CTE if n.startswith(("stg_", "int_", "fact_", "dim_", "date_dim",
                                                 "stock_feature_mart", "daily_stock_signals"))]

# Final SELECTs of the non-model queries (filled by the operator sections).
FINAL: dict[str, str] = {}


def _deps(sql: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
    return [n for n in CTE if n in words]


def compose(final_sql: str) -> str:
    """``WITH <needed CTEs in dependency order> <final_sql>``."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for dep in _deps(CTE[name]):
            if dep != name:
                visit(dep)
        order.append(name)

    for dep in _deps(final_sql):
        visit(dep)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} AS ({CTE[n]}\n)" for n in order)
    return f"WITH {body}\n{final_sql}"


def model_select(name: str) -> str:
    cols = ROUNDED.get(name)
    if not cols:
        return f"SELECT * FROM {name}"
    return f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in cols)}) FROM {name}"


def oracle_sql() -> dict[str, str]:
    out = {n: compose(model_select(n)) for n in MODEL_QUERIES}
    out.update({n: compose(sql) for n, sql in FINAL.items()})
    return out

# --------------------------------------------------------------------------
# operator queries
CTE["tick_events"] = """
  SELECT symbol, ts AS timestamp, d AS date, strftime(ts, '%H:%M:%S') AS time,
         value AS open, value + CAST(1.0 AS DOUBLE) AS high, value - CAST(1.0 AS DOUBLE) AS low,
         value + CAST(0.25 AS DOUBLE) AS close, k AS volume, event_id, event_type
  FROM ev"""
# Landed API responses: one per (symbol, block of 64 event ids); a block whose
# first tick is an error / signup event lands as an error / note body; view
# ticks carry no volume metric.
CTE["response_blocks"] = """
  SELECT symbol, event_id // 64 AS request_id, arg_min(event_type, event_id) AS first_type
  FROM tick_events GROUP BY symbol, event_id // 64"""
CTE["json_bars"] = """
  SELECT t.symbol, t.timestamp, t.open, t.high, t.low, t.close,
         CASE WHEN t.event_type = 'view' THEN CAST(0 AS BIGINT) ELSE t.volume END AS volume
  FROM tick_events t"""
# The newest five bars of each response.
CTE["json_recent_by_response"] = """
  SELECT symbol, timestamp, open, high, low, close,
         CASE WHEN event_type = 'view' THEN CAST(0 AS BIGINT) ELSE volume END AS volume
  FROM tick_events
  QUALIFY row_number() OVER (PARTITION BY symbol, event_id // 64 ORDER BY timestamp DESC NULLS LAST) <= 5"""
CTE["json_rejects"] = """
  SELECT symbol, request_id,
         CASE first_type WHEN 'error' THEN 'error_message' ELSE 'note' END AS reason,
         CAST(NULL AS VARCHAR) AS detail
  FROM response_blocks WHERE first_type IN ('error', 'signup')"""
CTE["json_recent5"] = """
  SELECT symbol, timestamp, open, high, low, close, volume FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC NULLS LAST) AS rn
    FROM json_bars) r WHERE rn <= 5"""
CTE["json_latest"] = """
  SELECT symbol, timestamp, open, high, low, close, volume FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC NULLS LAST) AS rn
    FROM json_bars) r WHERE rn = 1"""

FINAL["csv_dir_scan"] = """
  SELECT "Date", "Open", "High", "Low", "Close", CAST("Volume" AS INTEGER) AS "Volume"
  FROM sandp500_data"""
FINAL["sanitize_columns"] = "SELECT * FROM global_economy_indicators"
FINAL["static_load"] = "SELECT * FROM global_economy_indicators"
FINAL["intraday_json_parse"] = "SELECT * FROM json_bars"
FINAL["intraday_json_rejects"] = "SELECT * FROM json_rejects"
FINAL["stream_rejects"] = "SELECT * FROM json_rejects"
FINAL["latest_bar_from_json"] = "SELECT * FROM json_latest"
FINAL["recent_ticks"] = """
  SELECT * FROM json_bars ORDER BY timestamp DESC NULLS LAST, symbol ASC LIMIT 5"""
FINAL["recent_ticks_per_symbol"] = "SELECT * FROM json_recent5"
FINAL["schema_append"] = "SELECT * FROM json_recent5"
FINAL["stream_recent_append"] = "SELECT * FROM json_recent_by_response"
FINAL["shared_tick_table"] = """
  SELECT * FROM streaming_stock_data UNION ALL SELECT * FROM json_recent_by_response UNION ALL SELECT * FROM json_latest
  UNION ALL SELECT * FROM json_latest
  UNION ALL SELECT s.* FROM streaming_stock_data s
  WHERE xor(4294967295, list_reduce([4294967295] || list_transform(range(8 * length(symbol)),
              lambda i: CASE WHEN i % 8 = 0 THEN ascii(symbol[i // 8 + 1]) ELSE 0 END),
              lambda x, v: xor(xor(x, v) >> 1, 3988292384 * (xor(x, v) & 1)))) % 2 = 0"""
FINAL["latest_tick_per_symbol"] = """
  SELECT symbol, timestamp, last_close AS close, last_volume AS volume FROM latest_ticks"""
FINAL["kafka_record_encode"] = """
  SELECT symbol AS key,
         json_object('symbol', symbol,
                     'timestamp', CASE WHEN microsecond(timestamp) % 1000000 = 0
                                       THEN strftime(timestamp, '%Y-%m-%dT%H:%M:%S')
                                       ELSE strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') END,
                     'open', open, 'high', high, 'low', low, 'close', close, 'volume', volume,
                     'date', CAST(date AS VARCHAR), 'time', time)::VARCHAR AS value
  FROM stg_test_realtime_stock_data"""
FINAL["kafka_record_decode"] = "SELECT * FROM streaming_stock_data"
FINAL["stream_tick_ingest"] = "SELECT * FROM streaming_stock_data"
FINAL["append_sink"] = "SELECT * FROM streaming_stock_data"
FINAL["fallback_sink"] = "SELECT * FROM streaming_stock_data"
FINAL["split_date_time"] = """
  SELECT symbol, timestamp, date, time, open, high, low, close, volume FROM realtime_test_stock_data"""
FINAL["message_rejects"] = """
  SELECT CASE minute(timestamp) % 10 WHEN 0 THEN '' WHEN 1 THEN '{}' WHEN 2 THEN 'not json ' || symbol
           ELSE '{"symbol":"' || symbol || '","timestamp":"2024-01-01T00:00:00","volume":"many"}' END AS raw, 'malformed' AS reason
  FROM stg_test_realtime_stock_data WHERE minute(timestamp) % 10 <= 3
  UNION ALL SELECT CAST(count(*) AS VARCHAR), 'stored' FROM stg_test_realtime_stock_data WHERE minute(timestamp) % 10 > 3"""
FINAL["stream_fallback"] = "SELECT * FROM streaming_stock_data"
FINAL["publish_messages"] = "SELECT * FROM streaming_stock_data"
FINAL["load_counts"] = """
  SELECT 'static' AS load, count(*) AS observed, count(*) AS stored, count(*) AS exported FROM global_economy_indicators
  UNION ALL SELECT 'truncate', count(*), count(*), count(*) FROM test_sentiment"""
FINAL["csv_by_header"] = """
  SELECT "Date", CASE WHEN day("Date") % 2 = 0 THEN "Open" END AS "Open", "High", "Low", "Close", "Volume" FROM sandp500_data"""
FINAL["typed_raw_load"] = "SELECT * FROM int_test_earnings"
FINAL["daily_ohlcv_tied"] = """
  SELECT symbol, date, arg_min(open, (epoch_us(timestamp) // 1000000, event_id)) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, (epoch_us(timestamp) // 1000000, event_id)) AS close, CAST(sum(volume) AS BIGINT) AS volume
  FROM realtime_test_stock_data GROUP BY symbol, date"""
FINAL["built_tick_fact"] = "SELECT * FROM fact_stock_tick"
FINAL["stream_dual_sink"] = FINAL["split_date_time"]
FINAL["union_tick_feeds"] = """
  SELECT * FROM json_latest UNION ALL SELECT * FROM json_recent5
  UNION ALL SELECT * FROM streaming_stock_data"""
FINAL["floor_to_interval"] = """
  SELECT symbol, timestamp, time_bucket(INTERVAL 5 MINUTE, timestamp) AS bucket_start
  FROM stg_test_realtime_stock_data"""
FINAL["earnings_surprise"] = """
  SELECT symbol, date, est_eps, actual_eps,
         CASE WHEN est_eps IS NULL THEN NULL
              WHEN est_eps != 0 THEN round((actual_eps - est_eps) / est_eps * 100, 2)
              ELSE CAST(0.0 AS DOUBLE) END AS surprise_pct
  FROM stg_test_earnings"""
FINAL["crypto_daily_avg"] = model_select("crypto_daily_avg")
FINAL["truncate_load"] = "SELECT * FROM test_sentiment UNION ALL SELECT * FROM test_sentiment"
FINAL["parquet_export"] = "SELECT * FROM fact_daily_summary"
FINAL["stream_compacted_table"] = FINAL["split_date_time"]
FINAL["stream_changelog_compacted"] = "SELECT * FROM int_daily_stock_summary"
FINAL["levelled_daily_bars"] = "SELECT * FROM int_daily_stock_summary"
FINAL["stream_daily_ohlcv"] = "SELECT * FROM int_daily_stock_summary"
FINAL["stream_latest_tick"] = "SELECT symbol, last_close, last_volume FROM latest_ticks"


def _dq_sql(kind: str | None) -> str:
    from ledgerline.operators.quality import CHECKS
    parts = []
    for c in CHECKS:
        if kind is not None and c.test != kind:
            continue
        head = (f"SELECT '{c.test_id}' AS test_id, '{c.test}' AS test, '{c.model}' AS model, "
                f"'{','.join(c.columns)}' AS column_name, ")
        cols = ", ".join(c.columns)
        if c.test == "not_null":
            parts.append(head + f"CAST(count(*) FILTER (WHERE {cols} IS NULL) AS BIGINT) AS failures "
                                f"FROM {c.model}")
        else:
            where = f"WHERE {cols} IS NOT NULL " if c.test == "unique" else ""
            parts.append(head + f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {cols} FROM "
                                f"{c.model} {where}GROUP BY {cols} HAVING count(*) > 1) g")
    return "\nUNION ALL\n".join(parts)


FINAL["dq_not_null"] = _dq_sql("not_null")
FINAL["dq_unique"] = _dq_sql("unique")
FINAL["dq_unique_combination"] = _dq_sql("unique_combination")
FINAL["dq_results"] = _dq_sql(None)
FINAL["dq_results_stored"] = _dq_sql(None)
