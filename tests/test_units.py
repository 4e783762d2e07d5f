"""Edge cases on small literal frames (unit level; the registered queries
run over the driver tables)."""
import datetime as dt
import json
import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.json_codec import (decode_tick_messages, encode_tick_messages,
                                             intraday_rejects, intraday_rows,
                                             parse_response_bodies, split_decoded)
from ledgerline.functions.names import warehouse_identifier, sanitize_columns
from ledgerline.functions.numeric import earnings_surprise, nan_to_null
from ledgerline.functions.timecols import floor_to_interval, split_date_time
from ledgerline.operators import quality
from ledgerline.operators.rollup import daily_ohlcv
from ledgerline.operators.topk import latest_per_key, newest_per_key
from ledgerline.plans.queries import fixture_warehouse
from ledgerline.schemas import TICK_SCHEMA, TICK_SPLIT_SCHEMA
from ledgerline.sources.catalog import Warehouse
from ledgerline.sources.files import csv_dir_scan
from tests.conftest import SF_ORACLE, SF_SMALL

T = dt.datetime


def _responses(spark, bodies):
    rows = [("AAA", i, b) for i, b in enumerate(bodies)]
    return parse_response_bodies(spark.createDataFrame(rows, "symbol string, request_id bigint, body string"))


# -- intraday JSON --------------------------------------------------------------
def test_intraday_parse_missing_metric_defaults_to_zero(spark):
    body = json.dumps({"Time Series (1min)": {
        "2024-01-02 09:30:00": {"1. open": "10.5", "2. high": "11", "3. low": "10",
                                "4. close": "10.75", "5. volume": "1200"},
        "2024-01-02 09:31:00": {"1. open": "10.75", "4. close": "10.8"}}})
    rows = {r.timestamp: r for r in intraday_rows(_responses(spark, [body])).collect()}
    assert rows[T(2024, 1, 2, 9, 30)].volume == 1200
    late = rows[T(2024, 1, 2, 9, 31)]
    assert (late.high, late.low, late.volume) == (0.0, 0.0, 0)
    assert late.close == 10.8


def test_intraday_rejects_notice_error_and_malformed(spark):
    bodies = [json.dumps({"Note": "slow down"}), json.dumps({"Information": "limit"}),
              json.dumps({"Error Message": "bad symbol"}), "{not json", json.dumps({"x": 1})]
    parsed = _responses(spark, bodies)
    assert intraday_rows(parsed).count() == 0
    reasons = {r.request_id: r.reason for r in intraday_rejects(parsed).collect()}
    assert reasons == {0: "note", 1: "information", 2: "error_message", 3: "malformed",
                       4: "missing_series"}


# -- tick messages ---------------------------------------------------------------
def test_message_round_trip_and_bad_records(spark):
    ticks = spark.createDataFrame(
        [("AAA", T(2024, 1, 1, 9, 30, 0), dt.date(2024, 1, 1), "09:30:00", 1.0, 2.0, 0.5, 1.5, 10),
         ("BBB", T(2024, 1, 1, 9, 30, 1, 250), dt.date(2024, 1, 1), "09:30:01", 3.0, 4.0, 2.5, 3.5, 20)],
        TICK_SPLIT_SCHEMA)
    msgs = encode_tick_messages(ticks)
    values = [r.value for r in msgs.orderBy("key").collect()]
    assert json.loads(values[0])["timestamp"] == "2024-01-01T09:30:00"
    assert json.loads(values[1])["timestamp"] == "2024-01-01T09:30:01.000250"
    extra = json.dumps({"symbol": "CCC", "timestamp": "2024-01-01T10:00:00", "open": 1.0,
                        "unexpected": True})
    spaced = json.dumps({"symbol": "EEE", "timestamp": "2024-01-01 10:00:00.5", "volume": 1})
    allm = msgs.unionByName(spark.createDataFrame(
        [("CCC", extra), ("DDD", "{oops"), ("EEE", spaced)], "key string, value string"))
    good, bad = split_decoded(decode_tick_messages(allm))
    got = {r.symbol: r for r in good.collect()}
    assert got["EEE"].timestamp == T(2024, 1, 1, 10, 0, 0, 500000)
    assert got["BBB"].timestamp == T(2024, 1, 1, 9, 30, 1, 250) and got["BBB"].volume == 20
    assert got["CCC"].close is None and got["CCC"].volume is None  # absent -> NULL
    assert [r.raw for r in bad.collect()] == ["{oops"]


# -- names -------------------------------------------------------------------------
@pytest.mark.parametrize("raw,clean", [
    ("  Gross Domestic Product (GDP) ", "Gross_Domestic_Product_GDP"),
    ("2019 value", "_2019_value"), ("%%%", "_"), ("a--b__c", "a_b_c"), ("_x_", "x")])
def test_warehouse_identifier(raw, clean):
    assert warehouse_identifier(raw) == clean


def test_sanitize_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError):
        sanitize_columns(df)
    assert sanitize_columns(df, on_collision="suffix").columns == ["a_b", "a_b_2"]


# -- CSV directory scan -------------------------------------------------------------
def test_csv_scan_empty_dir_raises(spark):
    with pytest.raises(FileNotFoundError):
        csv_dir_scan(spark, tempfile.mkdtemp(prefix="ll-empty-"))


def test_csv_scan_by_position_and_strict(spark):
    d = tempfile.mkdtemp(prefix="ll-csv-")
    os.makedirs(f"{d}/sub")
    with open(f"{d}/a.csv", "w") as f:
        f.write("symbol,price\nAAA,1.5\nBBB,2.5\n")
    with open(f"{d}/sub/b.CSV", "w") as f:  # upper-case extension, nested
        f.write("price,symbol\n3.5,CCC\n")
    with open(f"{d}/notes.txt", "w") as f:
        f.write("ignored\n")
    df = csv_dir_scan(spark, d)
    assert df.count() == 3  # combined by position under the first header
    with pytest.raises(Exception):
        csv_dir_scan(spark, d, schema="symbol string, price double", strict=True).collect()


# -- numeric helpers -------------------------------------------------------------------
def test_nan_becomes_null_so_filters_drop_it(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (0.0,)], "x double")
    assert df.where("x > 0").count() == 2  # Spark: NaN > 0 is true
    assert nan_to_null(df).where("x > 0").count() == 1


def test_earnings_surprise_branches(spark):
    df = spark.createDataFrame([(2.0, 2.5), (0.0, 0.25), (None, None)], "est double, act double")
    got = [r.s for r in df.select(earnings_surprise(F.col("est"), F.col("act")).alias("s")).collect()]
    assert got == [25.0, 0.0, None]


def test_floor_and_split(spark):
    df = spark.createDataFrame([("A", T(2024, 1, 1, 9, 33, 59, 5))], "symbol string, timestamp timestamp_ntz")
    r = df.select(floor_to_interval(F.col("timestamp"), 5).alias("b")).first()
    assert r.b == T(2024, 1, 1, 9, 30)
    s = split_date_time(df).first()
    assert (s.date, s.time) == (dt.date(2024, 1, 1), "09:33:59")


# -- rollup, top-k ------------------------------------------------------------------
def test_ohlcv_null_time_sorts_first(spark):
    rows = [("A", None, dt.date(2024, 1, 1), None, 5.0, 6.0, 4.0, 5.5, 1),
            ("A", T(2024, 1, 1, 9), dt.date(2024, 1, 1), "09:00:00", 1.0, 2.0, 0.5, 1.5, 2),
            ("A", T(2024, 1, 1, 10), dt.date(2024, 1, 1), "10:00:00", 3.0, 9.0, 3.0, 3.5, 3)]
    df = spark.createDataFrame(rows, TICK_SPLIT_SCHEMA)
    r = daily_ohlcv(df).first()
    assert (r.open, r.close, r.high, r.low, r.volume) == (5.0, 3.5, 9.0, 0.5, 6)


def test_latest_and_newest_per_key(spark):
    rows = [("A", T(2024, 1, 1, h), float(h), h) for h in range(8)] + [("B", T(2024, 1, 1, 1), 1.0, 1)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double, volume long")
    latest = {r.symbol: r.close for r in latest_per_key(df, "symbol", "timestamp", ["close"]).collect()}
    assert latest == {"A": 7.0, "B": 1.0}
    top = newest_per_key(df, "symbol", 5)
    assert sorted(r.close for r in top.where("symbol = 'A'").collect()) == [3.0, 4.0, 5.0, 6.0, 7.0]
    assert top.count() == 6


def test_newest_per_key_plans_a_partial_group_limit(spark):
    ticks = fixture_warehouse(spark, SF_SMALL).ref("stg_test_realtime_stock_data")
    plan = newest_per_key(ticks, "symbol", 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# -- marts: empty economics, join bound ---------------------------------------------------
def test_empty_economics_gives_empty_mart(spark):
    src = fixture_warehouse(spark, SF_SMALL).resolver

    def sources(name):
        df = src(name)
        return df.limit(0) if name == "test_economic_indicators" else df

    wh = Warehouse(spark, sources, params={"economy_country": "NATION_0"})
    assert wh.ref("stock_feature_mart").count() == 0
    full = fixture_warehouse(spark, SF_SMALL).ref("stock_feature_mart")
    assert full.count() == 15


def test_quality_checks_pass_on_models(spark):
    quality.assert_passing(quality.run_checks(fixture_warehouse(spark, SF_SMALL)))


def test_quality_checks_catch_nulls_and_duplicates(spark):
    bad = spark.createDataFrame([("A", dt.date(2024, 1, 1)), ("A", dt.date(2024, 1, 1)),
                                 (None, dt.date(2024, 1, 2)), (None, None), (None, None)],
                                "symbol string, date date")
    wh = Warehouse(spark, lambda n: bad, models={"m": lambda w: bad})
    checks = [quality.Check("n1", "not_null", "m", ("symbol",)),
              quality.Check("u1", "unique", "m", ("symbol",)),
              quality.Check("c1", "unique_combination", "m", ("symbol", "date"))]
    got = {r.test_id: r.failures for r in quality.run_checks(wh, checks).collect()}
    # unique ignores NULL keys; the combination test counts (NULL, NULL) twice.
    assert got == {"n1": 3, "u1": 1, "c1": 2}
    with pytest.raises(AssertionError):
        quality.assert_passing(quality.run_checks(wh, checks))


def test_schema_conform_reorders_casts_and_fills(spark):
    df = spark.createDataFrame([(5, "A", 1.5)], "volume int, symbol string, close double")
    out = df.to(TICK_SCHEMA)
    assert out.columns == [f.name for f in TICK_SCHEMA.fields]
    r = out.first()
    assert (r.symbol, r.volume, r.close, r.open) == ("A", 5, 1.5, None)
    assert not math.isnan(r.close)


def test_runner_materialises_tables_and_pins_them(spark):
    from ledgerline.plans import runner
    from ledgerline.session import fresh_dir
    wh = fixture_warehouse(spark, SF_SMALL)
    root = fresh_dir(spark, "build")
    built = runner.build_and_test(wh, root)
    assert built["fact_daily_summary"] == 397 and built["int_daily_stock_summary"] is None
    assert spark.read.parquet(f"{root}/dim_stock").count() == 15
    # downstream refs now read the written table
    assert "FileScan parquet" in wh.ref("fact_vix")._jdf.queryExecution().executedPlan().toString()
    assert spark.table("stg_test_vix").count() == 30


def test_stream_dead_letters_malformed_messages(spark):
    from ledgerline.operators.sinks import publish_messages
    from ledgerline.session import fresh_dir
    from ledgerline.streaming import ticks as stream
    topic = fresh_dir(spark, "topic-bad")
    msgs = spark.createDataFrame(
        [("A", '{"symbol": "A", "timestamp": "2024-01-01T09:30:00", "open": 1.0, "volume": 3}'),
         ("B", "not json at all")], "key string, value string")
    assert publish_messages(msgs, topic, fmt="json") == 2
    out = fresh_dir(spark, "dlq")
    src = stream.message_stream(spark, topic)
    stream.run_to_end(stream.ingest_ticks(src, f"{out}/table", f"{out}/_ck1"))
    stream.run_to_end(stream.dead_letter_messages(stream.message_stream(spark, topic),
                                                  f"{out}/dlq", f"{out}/_ck2"))
    good = spark.read.parquet(f"{out}/table").collect()
    bad = spark.read.parquet(f"{out}/dlq").collect()
    assert [(r.symbol, r.volume) for r in good] == [("A", 3)]
    assert [(r.raw, r.reason) for r in bad] == [("not json at all", "malformed")]
    # a restarted query with the same checkpoint adds nothing (exactly-once file sink)
    stream.run_to_end(stream.ingest_ticks(stream.message_stream(spark, topic),
                                          f"{out}/table", f"{out}/_ck1"))
    assert spark.read.parquet(f"{out}/table").count() == 1


def test_models_queryable_with_sql(spark):
    wh = fixture_warehouse(spark, SF_SMALL)
    assert len(wh.register_views()) == 49
    n = spark.sql("""
        SELECT count(*) AS n FROM fact_daily_summary s
        JOIN dim_stock d USING (symbol) WHERE d.sector IS NOT NULL""").first().n
    assert n == wh.ref("fact_daily_summary").count()


def test_naive_order_key_ignores_session_time_zone(spark):
    rows = [("A", T(2024, 3, 10, 2, 30), dt.date(2024, 3, 10), "02:30:00", 1.0, 1.0, 1.0, 1.0, 1),
            ("A", T(2024, 3, 10, 3, 10), dt.date(2024, 3, 10), "03:10:00", 2.0, 2.0, 2.0, 2.0, 1)]
    df = spark.createDataFrame(rows, TICK_SPLIT_SCHEMA)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = daily_ohlcv(df).first()
        b = df.select(floor_to_interval(F.col("timestamp"), 5).alias("b")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.open, r.close) == (1.0, 2.0)  # 02:30 (inside the DST gap) is first
    assert [x.b for x in b] == [T(2024, 3, 10, 2, 30), T(2024, 3, 10, 3, 10)]


def test_bad_series_keys_go_to_rejects_not_failures(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        body = json.dumps({"Time Series (1min)": {
            "2024-03-10 02:30:00": {"1. open": "1"},          # inside a DST gap: still valid
            "2024-02-30 09:30:00": {"1. open": "2"},          # impossible date
            "yesterday": {"1. open": "3"}}})
        parsed = _responses(spark, [body])
        good = intraday_rows(parsed).collect()
        bad = intraday_rejects(parsed).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(r.timestamp, r.open) for r in good] == [(T(2024, 3, 10, 2, 30), 1.0)]
    assert sorted((r.reason, r.detail) for r in bad) == [
        ("bad_timestamp", "2024-02-30 09:30:00"), ("bad_timestamp", "yesterday")]


def test_dividend_filter_drops_nan_like_the_warehouse(spark):
    from ledgerline.plans.registry import MODELS
    rows = [("A", T(2024, 1, 1), 1.5, 0.1), ("A", T(2024, 1, 2), float("nan"), 0.1),
            ("A", T(2024, 1, 3), 0.0, 0.1), ("A", T(2024, 1, 4), None, 0.1)]
    df = spark.createDataFrame(rows, "symbol string, date timestamp_ntz, dividend_amount double, dividend_yield double")
    wh = Warehouse(spark, lambda n: df)
    assert [r.dividend_amount for r in wh.ref("int_test_dividends").collect()] == [1.5]
    assert "int_test_dividends" in MODELS


def test_strict_mode_raises_on_missing_series(spark):
    from ledgerline.functions.json_codec import require_series, series_key
    assert series_key("5min") == "Time Series (5min)"
    ok = _responses(spark, [json.dumps({"Time Series (1min)": {}})])
    assert require_series(ok) is ok
    with pytest.raises(ValueError, match="note"):
        require_series(_responses(spark, [json.dumps({"Note": "slow down"})]))


def test_time_strings_ignore_session_time_zone(spark):
    from ledgerline.functions.json_codec import iso_timestamp
    df = spark.createDataFrame([("A", T(2024, 3, 10, 2, 30, 0, 250))], "symbol string, timestamp timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = split_date_time(df).select("*", iso_timestamp(F.col("timestamp")).alias("iso")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.date, r.time, r.iso) == (dt.date(2024, 3, 10), "02:30:00", "2024-03-10T02:30:00.000250")


def test_truncate_load_replaces_and_exports(spark):
    from ledgerline.operators import sinks
    from ledgerline.session import fresh_dir
    df = fixture_warehouse(spark, SF_SMALL).source("test_vix")
    root = fresh_dir(spark, "tl")
    for _ in range(2):
        assert sinks.truncate_load(df, f"{root}/test_vix", export_root=f"{root}/export") == 30
    assert spark.read.parquet(f"{root}/test_vix").count() == 30
    assert spark.read.parquet(f"{root}/export/test_vix").count() == 30
    sinks.truncate_load(df, f"{root}/test_vix", truncate=False)
    assert spark.read.parquet(f"{root}/test_vix").count() == 60


def test_models_from_stored_raw_tables_equal_fixture_models(spark):
    """The production path: raw tables read from storage / the catalog."""
    from ledgerline.schemas import RAW_TABLES
    from ledgerline.session import fresh_dir
    from ledgerline.sources.catalog import CatalogSources, TableSources
    fx = fixture_warehouse(spark, SF_SMALL)
    root = fresh_dir(spark, "raw")
    for t in RAW_TABLES:
        fx.source(t).write.mode("overwrite").parquet(f"{root}/{t}")
        spark.read.parquet(f"{root}/{t}").createOrReplaceTempView(t)
    params = {"economy_country": "NATION_0"}
    for src in (TableSources(spark, root), CatalogSources(spark)):
        wh = Warehouse(spark, src, params=params)
        for m in ("daily_stock_signals_enriched", "stock_feature_mart", "date_dim"):
            got, want = wh.ref(m), fx.ref(m)
            assert got.count() == want.count()
            assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_latest_per_key_ranks_null_timestamps_last(spark):
    rows = [("A", None, 1.0), ("A", T(2024, 1, 1), 2.0), ("B", None, 3.0)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double")
    got = {r.symbol: r.close for r in latest_per_key(df, "symbol", "timestamp", ["close"]).collect()}
    assert got == {"A": 2.0, "B": 3.0}


def test_runner_partitions_tick_facts_by_date(spark):
    from ledgerline.plans import runner
    from ledgerline.session import fresh_dir
    wh = fixture_warehouse(spark, SF_SMALL)
    root = fresh_dir(spark, "build-part")
    runner.build(wh, root, names=["fact_stock_tick"])
    df = spark.read.parquet(f"{root}/fact_stock_tick")
    assert any("/date=2024-01-" in f for f in df.inputFiles())
    assert df.count() == 1000
    # a date filter prunes to that day's folder
    plan = df.where("date = DATE'2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_state_store_default_respects_an_explicit_choice(spark):
    from ledgerline.session import apply_streaming_state_conf
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "com.example.CustomStateStoreProvider")
        apply_streaming_state_conf(spark)
        assert spark.conf.get(key) == "com.example.CustomStateStoreProvider"
        spark.conf.unset(key)
        apply_streaming_state_conf(spark)
        assert spark.conf.get(key).endswith("RocksDBStateStoreProvider")
    finally:
        spark.conf.set(key, old)


def test_bucketed_facts_join_without_shuffle(spark):
    import uuid

    from ledgerline.plans import runner
    from ledgerline.session import fresh_dir
    db = f"ll_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{fresh_dir(spark, 'db')}'")
    wh = fixture_warehouse(spark, SF_SMALL)
    runner.build(wh, "", names=["fact_daily_summary", "fact_daily_features"], fmt="table",
                 buckets=4, database=db, register_views=False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force a sort-merge join
    try:
        joined = spark.table(f"{db}.fact_daily_summary").join(
            spark.table(f"{db}.fact_daily_features"), ["symbol", "date"])
        n = joined.count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    assert n == fixture_warehouse(spark, SF_SMALL).ref("fact_daily_summary").join(
        fixture_warehouse(spark, SF_SMALL).ref("fact_daily_features"), ["symbol", "date"]).count()


def test_incremental_rebuild_replaces_only_recent_days(spark):
    import os

    from ledgerline.plans import runner
    from ledgerline.session import fresh_dir
    wh = fixture_warehouse(spark, SF_SMALL)
    root = fresh_dir(spark, "incr")
    runner.build(wh, root, names=["fact_stock_tick"])
    table = f"{root}/fact_stock_tick"
    local = table.replace("file:", "", 1)
    old_day = sorted(os.listdir(f"{local}/date=2024-01-02"))
    runner.build(fixture_warehouse(spark, SF_SMALL), root, names=["fact_stock_tick"],
                 since=dt.date(2024, 1, 29))
    assert sorted(os.listdir(f"{local}/date=2024-01-02")) == old_day  # untouched
    df = spark.read.parquet(table)
    assert df.count() == 1000  # rebuilt days replaced, not duplicated
    full = fixture_warehouse(spark, SF_SMALL).ref("fact_stock_tick")
    assert df.exceptAll(full.select(*df.columns)).count() == 0
    # the day filter reaches the raw scan
    wh2 = fixture_warehouse(spark, SF_SMALL)
    plan = (wh2.ref("fact_stock_tick").where(F.col("timestamp") >= F.lit("2024-01-29").cast("date")
            .cast("timestamp_ntz"))._jdf.queryExecution().executedPlan().toString())
    assert "GreaterThanOrEqual(ts," in plan


def test_warning_checks_are_reported_not_raised(spark):
    from ledgerline.plans import runner
    from ledgerline.session import fresh_dir
    dup = fixture_warehouse(spark, SF_SMALL).source("sandp500_data")
    src = fixture_warehouse(spark, SF_SMALL).resolver

    def sources(name):  # the S&P feed delivered twice: a fan-out risk, not an error
        return dup.unionByName(dup) if name == "sandp500_data" else src(name)

    wh = Warehouse(spark, sources, params={"economy_country": "NATION_0"})
    got = {r.test_id: r.failures for r in quality.run_checks(wh, quality.WARNINGS).collect()}
    assert got == {"W-sp500": 30}
    runner.build_and_test(wh, fresh_dir(spark, "warn"), names=["dim_stock"])  # does not raise


# -- bad records never stop or pollute a load ------------------------------------
def test_unreadable_metrics_go_to_rejects(spark):
    from ledgerline.functions.json_codec import SERIES_KEY_1MIN
    bars = {"2024-01-01 00:00:01": {"1. open": "None"}, "2024-01-01 00:00:02": {"5. volume": "NaN"},
            "2024-01-01 00:00:03": {"1. open": "2", "5. volume": "7.9"}}
    parsed = parse_response_bodies(spark.createDataFrame([("A", 1, json.dumps({SERIES_KEY_1MIN: bars}))],
                                                         "symbol string, request_id bigint, body string"))
    assert [(r.open, r.volume) for r in intraday_rows(parsed).collect()] == [(2.0, 7)]
    assert sorted((r.reason, r.detail[-1]) for r in intraday_rejects(parsed).collect()) == [("bad_metric", "1"), ("bad_metric", "2")]


def test_tombstones_and_loose_messages(spark):
    from ledgerline.functions.json_codec import decode_tick_messages, split_decoded
    values = [None, "{}", "x", '{"symbol": "A", "timestamp": "2024-01-01T00:00:00Z", "volume": 1000.0}',
              '{"symbol": "A", "timestamp": "2024-01-01 00:00:00.5", "volume": 3}', '{"symbol": "A", "timestamp": "soon"}']
    good, bad = split_decoded(decode_tick_messages(spark.createDataFrame([(v,) for v in values], "value string")))
    assert sorted((r.timestamp, r.volume) for r in good.collect()) == [(T(2024, 1, 1), 1000), (T(2024, 1, 1, 0, 0, 0, 500000), 3)]
    assert sorted(r.raw for r in bad.collect()) == sorted(["", "{}", "x", values[5]])
