"""Property-based checks against brute-force Python definitions."""
import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.functions.names import warehouse_identifier
from ledgerline.operators.rollup import daily_ohlcv
from ledgerline.schemas import TICK_SPLIT_SCHEMA

IDENT = re.compile(r"^[A-Za-z_][0-9A-Za-z_]*$")


@given(st.text(max_size=40))
def test_warehouse_identifier_is_a_valid_idempotent_identifier(name):
    out = warehouse_identifier(name)
    assert IDENT.match(out)
    assert warehouse_identifier(out) == out
    assert "__" not in out.lstrip("_")


_ticks = st.lists(
    st.tuples(st.sampled_from(["A", "B"]),
              st.one_of(st.none(), st.datetimes(min_value=dt.datetime(2024, 1, 1),
                                                max_value=dt.datetime(2024, 1, 3))),
              st.integers(0, 1000), st.integers(0, 1000), st.integers(0, 50)),
    min_size=1, max_size=30)


def _brute_force(rows):
    """First/last by timestamp (NULL first, ties -> any value of the tied
    rows), max/min/sum per (symbol, date)."""
    groups = {}
    for sym, ts, o, c, v in rows:
        day = ts.date() if ts else None
        groups.setdefault((sym, day), []).append((ts, o, c, v))
    out = {}
    for key, g in groups.items():
        order = lambda r: (r[0] is not None, r[0] or dt.datetime.min)
        first, last = min(map(order, g)), max(map(order, g))
        opens = {r[1] for r in g if order(r) == first}
        closes = {r[2] for r in g if order(r) == last}
        out[key] = (opens, closes, max(r[1] + 1 for r in g), min(r[1] - 1 for r in g),
                    sum(r[3] for r in g))
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_ticks)
def test_daily_ohlcv_matches_brute_force(spark, rows):
    data = [(s, ts, ts.date() if ts else None, ts.strftime("%H:%M:%S") if ts else None,
             float(o), float(o + 1), float(o - 1), float(c), v) for s, ts, o, c, v in rows]
    got = {(r.symbol, r.date): r for r in daily_ohlcv(spark.createDataFrame(data, TICK_SPLIT_SCHEMA)).collect()}
    want = _brute_force(rows)
    assert set(got) == set(want)
    for key, (opens, closes, hi, lo, vol) in want.items():
        r = got[key]
        assert r.open in opens and r.close in closes
        assert (r.high, r.low, r.volume) == (hi, lo, vol)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.datetimes(min_value=dt.datetime(1960, 1, 1), max_value=dt.datetime(2100, 1, 1)),
                min_size=1, max_size=40))
def test_naive_time_functions_match_python_in_any_session_zone(spark, stamps):
    from pyspark.sql import functions as F

    from ledgerline.functions.json_codec import iso_timestamp, series_time
    from ledgerline.functions.timecols import floor_to_interval, naive_epoch_micros, split_date_time
    df = spark.createDataFrame([("A", t) for t in stamps], "symbol string, timestamp timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = (split_date_time(df)
                .select("timestamp", "date", "time",
                        iso_timestamp(F.col("timestamp")).alias("iso"),
                        naive_epoch_micros(F.col("timestamp")).alias("micros"),
                        floor_to_interval(F.col("timestamp"), 5).alias("floor"),
                        series_time(F.col("timestamp").cast("string")).alias("reparsed"))
                .collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    epoch = dt.datetime(1970, 1, 1)
    for r in rows:
        t = r.timestamp
        micros = (t - epoch) // dt.timedelta(microseconds=1)
        assert r.iso == t.isoformat()
        assert r.micros == micros
        assert r.floor == epoch + dt.timedelta(microseconds=micros - micros % 300_000_000)
        assert (r.date, r.time) == (t.date(), t.strftime("%H:%M:%S"))
        assert r.reparsed == t


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 10_000)),
                min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1])),
       st.integers(1, 6))
def test_newest_per_key_matches_brute_force(spark, rows, n):
    from ledgerline.operators.topk import latest_per_key, newest_per_key
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(s, base + dt.timedelta(seconds=x), float(x)) for s, x in rows],
                               "symbol string, timestamp timestamp_ntz, close double")
    got = sorted((r.symbol, r.close) for r in newest_per_key(df, "symbol", n).collect())
    want = []
    for sym in {s for s, _ in rows}:
        xs = sorted((x for s, x in rows if s == sym), reverse=True)[:n]
        want += [(sym, float(x)) for x in xs]
    assert got == sorted(want)
    latest = {r.symbol: r.close for r in latest_per_key(df, "symbol", "timestamp", ["close"]).collect()}
    assert latest == {sym: float(max(x for s, x in rows if s == sym)) for sym in {s for s, _ in rows}}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["A", "B", "C"])),
                          st.one_of(st.none(), st.integers(1, 3))), min_size=1, max_size=30))
def test_quality_checks_match_brute_force(spark, rows):
    from collections import Counter

    from ledgerline.operators import quality
    from ledgerline.sources.catalog import Warehouse
    df = spark.createDataFrame(rows, "k string, d int")
    wh = Warehouse(spark, lambda n: df, models={"m": lambda w: df})
    checks = [quality.Check("n", "not_null", "m", ("k",)), quality.Check("n2", "not_null", "m", ("d",)),
              quality.Check("u", "unique", "m", ("k",)),
              quality.Check("c", "unique_combination", "m", ("k", "d"))]
    got = {r.test_id: r.failures for r in quality.run_checks(wh, checks).collect()}
    keys = Counter(k for k, _ in rows if k is not None)
    pairs = Counter(rows)
    assert got == {"n": sum(k is None for k, _ in rows), "n2": sum(d is None for _, d in rows),
                   "u": sum(c > 1 for c in keys.values()), "c": sum(c > 1 for c in pairs.values())}


_bar = st.fixed_dictionaries({}, optional={
    "1. open": st.floats(0, 1e4, allow_nan=False).map(lambda x: f"{x:.4f}"),
    "2. high": st.floats(0, 1e4, allow_nan=False).map(lambda x: f"{x:.4f}"),
    "3. low": st.floats(0, 1e4, allow_nan=False).map(lambda x: f"{x:.4f}"),
    "4. close": st.floats(0, 1e4, allow_nan=False).map(lambda x: f"{x:.4f}"),
    "5. volume": st.integers(0, 10**9).map(str)})


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.datetimes(min_value=dt.datetime(2020, 1, 1), max_value=dt.datetime(2030, 1, 1))
                       .map(lambda t: t.replace(microsecond=0).strftime("%Y-%m-%d %H:%M:%S")),
                       _bar, min_size=1, max_size=20))
def test_intraday_parse_matches_python(spark, series):
    import json

    from ledgerline.functions.json_codec import intraday_rows, parse_response_bodies
    body = json.dumps({"Meta Data": {"2. Symbol": "AAA"}, "Time Series (1min)": series})
    df = spark.createDataFrame([("AAA", 1, body)], "symbol string, request_id bigint, body string")
    got = sorted(tuple(r) for r in intraday_rows(parse_response_bodies(df)).collect())
    want = sorted(("AAA", dt.datetime.strptime(k, "%Y-%m-%d %H:%M:%S"),
                   float(v.get("1. open", 0)), float(v.get("2. high", 0)), float(v.get("3. low", 0)),
                   float(v.get("4. close", 0)), int(float(v.get("5. volume", 0))))
                  for k, v in series.items())
    assert got == want
