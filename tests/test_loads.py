"""Ties, fallback streams, header-aware scans, typed loads, unique messages, loads in one evaluation, stored checks."""
import datetime as dt
import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerline.operators import quality, sinks
from ledgerline.operators.rollup import daily_ohlcv
from ledgerline.operators.topk import latest_per_key, newest_per_key
from ledgerline.schemas import RAW_TYPES, TICK_SCHEMA, TICK_SPLIT_SCHEMA
from ledgerline.session import fresh_dir
from ledgerline.sources.catalog import Warehouse
from ledgerline.sources.feeds import _file_system, read_batches
from ledgerline.sources.files import csv_by_header
from ledgerline.sources.typed import TypedSources, coerce
from ledgerline.streaming import fallback, ticks as st

DAY = dt.date(2024, 1, 1)


def tied_ticks(rnd, n):
    """Ticks of two symbols in three seconds and without a time, with ids."""
    rows = []
    for i in range(n):
        ts = rnd.choice([None, *(dt.datetime(2024, 1, 1, 9, 0, s) for s in range(3))])
        rows.append((rnd.choice("AB"), ts, DAY, None, *(float(rnd.randrange(50)) for _ in range(4)), rnd.randrange(9), i))
    rnd.shuffle(rows)
    return rows


def test_ties_do_not_depend_on_the_partitioning(spark):
    rows = tied_ticks(random.Random(1), 200)
    df = spark.createDataFrame(rows, StructType([*TICK_SPLIT_SCHEMA.fields, StructField("id", LongType())]))
    shapes = [df.coalesce(1), df.repartition(7), df.orderBy(F.desc("close")), df.repartition(3, "volume")]
    by_id, by_values, latest, newest = (
        [sorted(map(tuple, f(s).collect()), key=str) for s in shapes] for f in (
            lambda s: daily_ohlcv(s, tie="id").select("symbol", "open", "close"), daily_ohlcv,
            lambda s: latest_per_key(s, "symbol", "timestamp", ["open", "close", "volume"]),
            lambda s: newest_per_key(s, "symbol", 3)))
    for results in (by_id, by_values, latest, newest):
        assert all(r == results[0] for r in results)
    order = lambda r: (r[1] is not None, r[1] or dt.datetime.min, r[9])
    assert by_id[0] == [(s, min((r for r in rows if r[0] == s), key=order)[4], max((r for r in rows if r[0] == s), key=order)[7]) for s in "AB"]


def test_ties_across_micro_batches(spark):
    rows = [r[:9] for r in tied_ticks(random.Random(2), 60)]
    whole = sorted(map(tuple, daily_ohlcv(spark.createDataFrame(rows, TICK_SPLIT_SCHEMA)).collect()), key=str)
    for cut in (7, 30):
        parts = [st.daily_partials(spark.createDataFrame(rows[i:i + cut], TICK_SPLIT_SCHEMA)) for i in range(0, len(rows), cut)]
        merged = st.merge_daily(reduce(DataFrame.unionByName, parts)).select("symbol", "date", "open", "high", "low", "close", "volume")
        assert sorted(map(tuple, merged.collect()), key=str) == whole


def tick_files(spark, n):
    path = fresh_dir(spark, "tick-files")
    rows = [(f"S{i}", dt.datetime(2024, 1, 1, 9, i), 1.0, 2.0, 0.5, 1.5, i) for i in range(n)]
    for r in rows:
        spark.createDataFrame([r], TICK_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def all_symbols(spark, out):
    rows = read_batches(spark, f"{out}/table", TICK_SCHEMA).select("symbol").unionByName(
        fallback.read_fallback(spark, f"{out}/fallback", TICK_SCHEMA).select("symbol"))
    return sorted(r.symbol for r in rows.collect())


@pytest.mark.parametrize("first_fails", [True, False])
def test_fallback_counts_a_replayed_batch_once(spark, first_fails):
    path, out = tick_files(spark, 3), fresh_dir(spark, "fallback")
    load, undo = fallback.feed_primary(f"{out}/table")
    down = {"now": first_fails}

    def maybe(df, n, writer):
        load(df, n, writer)  # the rows may have arrived when the load fails
        if down["now"] and n >= 1:
            raise RuntimeError("no connection")

    def run():
        src = st.tick_file_stream(spark, path, TICK_SCHEMA, {"maxFilesPerTrigger": "1"})
        st.run_to_end(fallback.routed_append(src, (maybe, undo), f"{out}/fallback", f"{out}/_c", st.REPLAY))

    run()
    assert all_symbols(spark, out) == ["S0", "S1", "S2"]
    before = fallback.routes(spark, f"{out}/fallback")
    assert sorted(before.values()) == (["fallback", "fallback", "primary"] if first_fails else ["primary"] * 3)
    # the driver dies before Spark's commit of the last batch: nothing is done twice
    commit = f"{out}/_c/commits"

    def forget(p):
        fs, file = _file_system(spark, p)
        assert fs.delete(file, False)
    forget(f"{commit}/2")
    run()
    assert fallback.routes(spark, f"{out}/fallback") == before and all_symbols(spark, out) == ["S0", "S1", "S2"]
    # it dies before the record as well, and the sink's state has changed meanwhile
    forget(f"{commit}/2")
    (writer, _), route = next((k, v) for k, v in before.items() if k[1] == 2)
    forget(f"{out}/fallback/_routes/2-{writer}-{route}")
    down["now"] = not first_fails
    run()
    assert fallback.routes(spark, f"{out}/fallback")[writer, 2] == ("primary" if first_fails else "fallback")
    assert all_symbols(spark, out) == ["S0", "S1", "S2"]


def test_recent_bars_go_to_the_fallback(spark):
    body = '{"Time Series (1min)": {"2024-01-01 09:00:00": {"1. open": "1", "2. high": "2", "3. low": "0", "4. close": "1", "5. volume": "7"}}}'
    src, out = fresh_dir(spark, "responses"), fresh_dir(spark, "recent")
    spark.createDataFrame([("A", 1, body)], "symbol string, request_id long, body string").write.mode("overwrite").json(src)
    fs, blocked = _file_system(spark, f"{out}/table")
    fs.create(blocked, True).close()  # a file where the table should be
    st.run_to_end(st.recent_append(st.response_stream(spark, src), f"{out}/table", f"{out}/_c", fallback_root=f"{out}/fallback"))
    assert [(r.symbol, r.volume) for r in fallback.read_fallback(spark, f"{out}/fallback", TICK_SCHEMA).collect()] == [("A", 7)]


def test_csv_by_header(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "x.csv").write_text("Day,Total (USD),Name\n2024-01-01,1.5,é\n")
    (tmp_path / "a b" / "y%20z.CSV").write_text('﻿Name,"Day",Other,Total (USD)\r\n"p, q",2024-01-02,z,2.5\r\n', newline="")
    (tmp_path / "lacks.csv").write_text("Name\nr\ns")
    (tmp_path / "bare.csv").write_text("Day,Name")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "note.txt").write_text("Name\nnot read\n")
    df = csv_by_header(spark, str(tmp_path), "Day date, `Total (USD)` double, Name string")
    assert sorted(map(tuple, df.collect()), key=str) == sorted([
        (DAY, 1.5, "é"), (dt.date(2024, 1, 2), 2.5, "p, q"), (None, None, "r"), (None, None, "s")], key=str)
    none = tmp_path / "none"
    none.mkdir()
    for missing in (none, tmp_path / "absent"):
        with pytest.raises(FileNotFoundError):
            csv_by_header(spark, str(missing), "a string")


def test_declared_types(spark):
    df = spark.createDataFrame([("2024-01-02 10:00:00", "NaN", " 12.0 ", "k", float("nan")), ("soon", "1.5", "1.5", None, 2.0), (None, "", "", "", None)],
                               "Date string, Open string, Volume string, more string, Close double")
    got = coerce(df, RAW_TYPES["sandp500_data"])
    assert got.columns == ["Date", "Open", "High", "Low", "Close", "Volume", "more"]
    assert [tuple(r) for r in got.collect()] == [(dt.date(2024, 1, 2), None, None, None, None, 12, "k"), (None, 1.5, None, None, 2.0, None, None), (None, None, None, None, None, None, "")]
    other = spark.createDataFrame([(1,)], "a int")
    assert TypedSources(lambda name: other)("tick_events") is other


def test_unique_messages_drop_copies_alone(spark):
    topic = fresh_dir(spark, "topic")
    rows = [("A", "1"), ("A", "2"), ("B", "1"), (None, None)]
    for _ in range(2):
        sinks.publish_messages(spark.createDataFrame(rows, "key string, value string").coalesce(1), topic, "json")
    out = fresh_dir(spark, "unique")
    unique = st.unique_messages(st.message_stream(spark, topic, options={"maxFilesPerTrigger": "1"}, arrival=True))
    st.run_to_end(unique.writeStream.option("checkpointLocation", f"{out}/_c").trigger(availableNow=True)
                  .format("parquet").option("path", f"{out}/t").start())
    assert sorted(map(tuple, spark.read.parquet(f"{out}/t").collect()), key=str) == sorted(rows, key=str)


def test_loads_evaluate_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    df = spark.range(100).coalesce(2).mapInPandas(counting, "id long")
    out = fresh_dir(spark, "once")
    assert sinks.static_load(df, f"{out}/a", export_root=f"{out}/export") == 100 and seen.value == 100
    assert sinks.truncate_load(df, f"{out}/b", export_root=f"{out}/export", options={"compression": "gzip"}) == 100 and seen.value == 200
    assert {spark.read.parquet(f"{out}/{t}").count() for t in ("a", "b", "export/a", "export/b")} == {100}


def test_stored_checks_find_what_the_lazy_ones_find(spark):
    def model(wh):
        return spark.createDataFrame([("A", 1), ("A", 1), (None, 2), (None, 2)], "symbol string, date int")
    checks = [quality.Check("1", "not_null", "m", ("symbol",)), quality.Check("2", "unique", "m", ("symbol",)),
              quality.Check("3", "unique_combination", "m", ("symbol", "date")), quality.Check("4", "not_null", "m", ("date",))]
    runs = [f(Warehouse(spark, None, {"m": model}), *a, checks) for f, a in ((quality.run_checks, ()), (quality.run_checks_stored, (fresh_dir(spark, "checks"),)))]
    lazy, stored = (sorted(map(tuple, r.collect())) for r in runs)
    assert lazy == stored and [r[4] for r in stored] == [2, 1, 2, 0]


def test_repeated_ticks_land_in_further_responses(spark, tmp_path):
    """Ticks of one symbol, block and timestamp: every bar is parsed, the newest are ranked over the whole request."""
    from datetime import datetime

    from ledgerline.plans.queries import QUERIES
    at = [datetime(2024, 1, 1, 9, 30, s, 250000) for s in range(7)]
    kinds = ["error", "view", "click", "click", "purchase", "click", "view"]
    rows = [(i, at[i], user, kinds[i], float(i), f'{{"k": {i}}}') for i in range(7) for user in (1, 26, 26, 2)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{tmp_path}/events.parquet")
    sf = str(tmp_path)
    bars = sorted((f"NATION_{u % 25}", t, v, 0 if k == "view" else int(v)) for _, t, u, k, v, _ in rows)
    got = QUERIES["intraday_json_parse"](spark, sf).select("symbol", "timestamp", "open", "volume").collect()
    assert sorted(map(tuple, got)) == bars
    rejects = QUERIES["intraday_json_rejects"](spark, sf).collect()
    assert sorted((r.symbol, r.request_id, r.reason) for r in rejects) == [(f"NATION_{n}", 0, "error_message") for n in (1, 2)]
    newest = [b for n in (1, 2) for b in sorted((b for b in bars if b[0] == f"NATION_{n}"), key=lambda b: b[1])[-5:]]
    for name in ("stream_recent_append", "recent_ticks_per_symbol"):
        got = QUERIES[name](spark, sf).select("symbol", "timestamp", "open", "volume").collect()
        assert sorted(map(tuple, got)) == sorted(newest), name
