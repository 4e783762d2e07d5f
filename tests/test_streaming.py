"""Streaming results equal the batch models when data arrives over many
micro-batches."""

from collections import Counter

from ledgerline.plans.queries import fixture_warehouse
from ledgerline.schemas import TICK_SPLIT_SCHEMA
from ledgerline.session import fresh_dir
from ledgerline.streaming import ticks as st
from tests.conftest import SF_SMALL


def _landed_in_time_slices(spark, n_files=6):
    ticks = fixture_warehouse(spark, SF_SMALL).ref("stg_test_realtime_stock_data")
    path = fresh_dir(spark, "tick-slices")
    ticks.repartitionByRange(n_files, "timestamp").write.mode("overwrite").parquet(path)
    return ticks, path


def test_daily_ohlcv_stream_over_many_batches_equals_batch(spark):
    ticks, path = _landed_in_time_slices(spark)
    out = fresh_dir(spark, "multi-ohlcv")
    src = st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA, {"maxFilesPerTrigger": "1"})
    q = st.daily_ohlcv_stream(src, f"{out}/cl", f"{out}/_ck")
    st.run_to_end(q)
    assert q.lastProgress["batchId"] >= 5  # really several micro-batches
    got = st.read_daily(spark, f"{out}/cl")
    want = fixture_warehouse(spark, SF_SMALL).ref("int_daily_stock_summary")
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_latest_tick_stream_over_many_batches_equals_batch(spark):
    ticks, path = _landed_in_time_slices(spark)
    out = fresh_dir(spark, "multi-latest")
    src = st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA, {"maxFilesPerTrigger": "1"})
    st.run_to_end(st.latest_tick_stream(src, f"{out}/cl", f"{out}/_ck"))
    got = st.read_latest(spark, f"{out}/cl")
    mart = fixture_warehouse(spark, SF_SMALL).ref("stock_feature_mart")
    want = mart.select("symbol", "last_close", "last_volume")
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_restart_from_checkpoint_adds_no_duplicates(spark):
    ticks, path = _landed_in_time_slices(spark, 3)
    out = fresh_dir(spark, "dual-restart")
    for _ in range(2):  # second run resumes from the checkpoint: nothing new
        src = st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA, {"maxFilesPerTrigger": "1"})
        st.run_to_end(st.dual_sink(src, f"{out}/topic", f"{out}/table", f"{out}/_ck"))
    table = st.read_batches(spark, f"{out}/table")
    assert table.count() == ticks.count()
    assert spark.read.json(f"{out}/topic").count() == ticks.count()


def test_closed_days_are_emitted_once_in_append_mode(spark):
    ticks, path = _landed_in_time_slices(spark, 6)
    # A 40-day delay on 30 days of data: the watermark never closes a day.
    out = fresh_dir(spark, "closed-days")
    src = st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA, {"maxFilesPerTrigger": "1"})
    st.run_to_end(st.daily_ohlcv_stream(src, f"{out}/closed", f"{out}/_ck", delay="40 days",
                                        output="closed"))
    # No delay: once the watermark reaches the last tick, every day but the
    # last is closed and emitted exactly once, equal to the batch model.
    out2 = fresh_dir(spark, "closed-days-2")
    src = st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA)
    st.run_to_end(st.daily_ohlcv_stream(src, f"{out2}/closed", f"{out2}/_ck", delay="0 seconds",
                                        output="closed"))
    closed = spark.read.parquet(f"{out2}/closed")
    want = fixture_warehouse(spark, SF_SMALL).ref("int_daily_stock_summary")
    last_day = want.agg({"date": "max"}).first()[0]
    full = want.where(want.date < last_day)
    assert closed.count() == full.count()
    assert closed.exceptAll(full.select(*closed.columns)).count() == 0
    assert spark.read.parquet(f"{out}/closed").count() == 0


def test_changelog_compaction_keeps_the_state(spark):
    ticks, path = _landed_in_time_slices(spark, 6)
    out = fresh_dir(spark, "compact")
    src = st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA, {"maxFilesPerTrigger": "2"})
    st.run_to_end(st.daily_ohlcv_stream(src, f"{out}/cl", f"{out}/_ck", delay="40 days"))
    before = st.read_daily(spark, f"{out}/cl")
    upto = st.compact_changelog(spark, f"{out}/cl")
    assert upto is not None and upto >= 2
    after = st.read_daily(spark, f"{out}/cl")
    assert after.count() == before.count()
    assert after.exceptAll(before.select(*after.columns)).count() == 0
    # a second run has nothing to fold; the part alone is enough, whatever became of the batches
    assert st.compact_changelog(spark, f"{out}/cl") == upto
    files = after.inputFiles()
    assert files and all("/_compacted/batch_upto=" in f for f in files)


def test_batch_compaction_keeps_all_rows_while_stream_continues(spark):
    ticks, path = _landed_in_time_slices(spark, 6)
    out = fresh_dir(spark, "compact-batches")
    src = st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA, {"maxFilesPerTrigger": "2"})
    st.run_to_end(st.dual_sink(src, f"{out}/topic", f"{out}/table", f"{out}/_ck"))
    before = st.read_batches(spark, f"{out}/table")
    upto = st.compact_batches(spark, f"{out}/table")
    after = st.read_batches(spark, f"{out}/table")
    assert after.count() == before.count() == ticks.count()
    assert after.exceptAll(before).count() == 0
    # More data arrives after compaction: read = compacted part + new batches.
    ticks.limit(100).write.mode("append").parquet(path)
    src = st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA, {"maxFilesPerTrigger": "2"})
    st.run_to_end(st.dual_sink(src, f"{out}/topic", f"{out}/table", f"{out}/_ck"))
    assert st.read_batches(spark, f"{out}/table").count() == ticks.count() + 100
    assert st.compact_batches(spark, f"{out}/table") > upto
    assert st.read_batches(spark, f"{out}/table").count() == ticks.count() + 100


def test_readers_before_any_batch(spark):
    import pytest
    out = fresh_dir(spark, "nothing-yet")
    with pytest.raises(FileNotFoundError):
        st.read_latest(spark, f"{out}/cl")
    empty = st.read_batches(spark, f"{out}/table", schema=TICK_SPLIT_SCHEMA)
    assert empty.count() == 0 and empty.columns == [f.name for f in TICK_SPLIT_SCHEMA.fields]


def test_streaming_rollup_aggregates_partially_before_the_state_store(spark, capsys):
    ticks, path = _landed_in_time_slices(spark, 2)
    out = fresh_dir(spark, "stream-plan")
    q = st.daily_ohlcv_stream(st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA),
                              f"{out}/cl", f"{out}/_ck", output="closed")
    st.run_to_end(q)
    capsys.readouterr()
    q.explain()
    plan = capsys.readouterr().out
    assert "StateStoreSave" in plan and "StateStoreRestore" in plan
    assert "partial_min_by" in plan and "partial_max_by" in plan  # map-side combine
    assert plan.index("partial_min_by") > plan.index("StateStoreRestore")  # below it in the tree
    assert "SortAggregate" not in plan


def test_shuffled_late_files_one_per_batch_equal_the_batch_rollup(spark):
    ticks = fixture_warehouse(spark, SF_SMALL).ref("stg_test_realtime_stock_data")
    path, out = fresh_dir(spark, "late"), fresh_dir(spark, "late-out")
    # newest first: every later file is late
    for i, part in enumerate(reversed(ticks.randomSplit([1.0] * 4, 7))):
        part.coalesce(1).write.mode("append").parquet(path)
    src = st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA, {"maxFilesPerTrigger": "1", "latestFirst": "true"})
    st.run_to_end(st.daily_ohlcv_stream(src, f"{out}/cl", f"{out}/_ck"))
    got = st.read_daily(spark, f"{out}/cl")
    want = fixture_warehouse(spark, SF_SMALL).ref("int_daily_stock_summary")
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0


def test_recent_append_ranks_inside_a_response(spark):
    import json
    from ledgerline.functions.json_codec import METRIC_KEYS, SERIES_KEY_1MIN
    bar = dict.fromkeys(METRIC_KEYS.values(), "1")
    path = fresh_dir(spark, "responses")
    for r in range(4):
        body = {SERIES_KEY_1MIN: {f"2024-01-0{r + 1} 00:00:{i:02d}": bar for i in range(10)}}
        spark.createDataFrame([("A", r, json.dumps(body))], "symbol string, request_id bigint, body string").coalesce(1).write.mode("append").json(path)
    for options in ({}, {"maxFilesPerTrigger": "1"}):
        out = fresh_dir(spark, "recent")
        st.run_to_end(st.recent_append(st.response_stream(spark, path, options), f"{out}/t", f"{out}/_ck", n=5))
        assert st.read_batches(spark, f"{out}/t").count() == 20


def test_append_after_ingest_is_seen(spark):
    from ledgerline.sources.feeds import append_rows
    ticks, path = _landed_in_time_slices(spark, 2)
    out = fresh_dir(spark, "shared")
    st.run_to_end(st.dual_sink(st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA), f"{out}/topic", f"{out}/t", f"{out}/_ck"))
    st.compact_batches(spark, f"{out}/t")
    append_rows(ticks.limit(7), f"{out}/t", "job-1")
    append_rows(ticks.limit(7), f"{out}/t", "job-1")  # a repeated job replaces its rows
    assert st.read_batches(spark, f"{out}/t").count() == ticks.count() + 7


def test_two_consumers_share_a_table(spark):
    """Queries of one kind under their own checkpoints keep every row, also one that starts after a compaction."""
    ticks, path = _landed_in_time_slices(spark, 2)
    n = ticks.count()
    out = fresh_dir(spark, "shared-writers")
    for k in range(3):
        source = st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA, {"maxFilesPerTrigger": "1"})
        st.run_to_end(st.dual_sink(source, f"{out}/topic", f"{out}/t", f"{out}/_ck{k}"))
        assert st.read_batches(spark, f"{out}/t").count() == n * (k + 1)
        st.compact_batches(spark, f"{out}/t")
        assert st.read_batches(spark, f"{out}/t").count() == n * (k + 1)


def test_restart_keeps_its_writer_and_a_fresh_checkpoint_gets_another(spark):
    from ledgerline.sources.feeds import folders
    ticks, path = _landed_in_time_slices(spark, 2)
    out = fresh_dir(spark, "writers")
    for checkpoint in ("_a", "_a", "_b"):
        st.run_to_end(st.dual_sink(st.tick_file_stream(spark, path, TICK_SPLIT_SCHEMA), f"{out}/topic", f"{out}/t", f"{out}/{checkpoint}"))
    _, batches, _ = folders(spark, f"{out}/t")
    assert len(batches) == 2
    assert st.read_batches(spark, f"{out}/t").count() == 2 * ticks.count()


def test_feed_table_without_success_markers_and_with_plain_appends(spark):
    from ledgerline.operators.sinks import append_sink
    from ledgerline.sources.feeds import append_rows
    key = "spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark._jsc.hadoopConfiguration()
    conf.set(key.removeprefix("spark.hadoop."), "false")
    try:
        root = f"{fresh_dir(spark, 'markers')}/t"
        append_rows(spark.range(5), root, "one")
        append_sink(spark.range(3), root)
        assert st.read_batches(spark, root).count() == 8
    finally:
        conf.unset(key.removeprefix("spark.hadoop."))


def test_one_pass_rejects_survive_a_replayed_batch(spark):
    """Good rows and rejects of a batch replace themselves when the batch runs again."""
    import os
    import shutil
    topic, out = fresh_dir(spark, "rejects-topic"), fresh_dir(spark, "rejects")
    rows = [("A", '{"symbol":"A","timestamp":"2024-01-01T00:00:00","volume":1}'), ("A", "{}"), ("A", None), ("A", "no json")]
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.mode("overwrite").json(topic)
    for _ in range(2):
        st.run_to_end(st.ingest_and_reject(st.message_stream(spark, topic), f"{out}/t", f"{out}/r", f"{out}/_ck"))
        assert st.read_batches(spark, f"{out}/t").count() == 1
        assert sorted(r["raw"] for r in st.read_batches(spark, f"{out}/r").collect()) == ["", "no json", "{}"]
        shutil.rmtree(os.path.join(f"{out}/_ck".replace("file:", "", 1), "commits"))  # as if the driver was lost before the commit


def test_nan_earnings_are_no_events(spark):
    from ledgerline.sources import Warehouse
    rows = spark.createDataFrame([("A", None, 1.0, float("nan"), 0.0), ("B", None, 1.0, 2.0, 0.0), ("C", None, 1.0, None, 0.0)],
                                 "symbol string, date date, est_eps double, actual_eps double, surprise_pct double")
    got = Warehouse(spark, lambda name: rows).ref("int_test_earnings").collect()
    assert [r["symbol"] for r in got] == ["B"]


def test_levels_bound_the_parts_of_many_batches(spark):
    """With fan-out 3, thirty runs leave at most two parts on each of four levels, and every row counts once."""
    from ledgerline.sources.feeds import compact, expire, folders, write_batch
    root = f"{fresh_dir(spark, 'levels')}/t"
    for n in range(30):
        write_batch(spark.range(n * 10, n * 10 + 10, 1, 1), root, n, "batch", "w")
        assert compact(spark, root, fanout=3) == n
        parts, batches, _ = folders(spark, root)
        live = parts["batch", "w"]
        assert not batches and max(Counter(p.level for p in live).values()) <= 2 and live[-1].end == n
        assert [p.start for p in live] == [0, *[p.end + 1 for p in live[:-1]]]
    assert {p.level for p in live} <= {0, 1, 2, 3} and len(live) <= 8
    got = st.read_batches(spark, root)
    assert sorted(r.id for r in got.collect()) == list(range(300)) and len(got.inputFiles()) == len(live)
    # nothing goes before its time; then only what the live parts do not need
    assert expire(spark, root, hours=1) == 0
    assert expire(spark, root, hours=0) > 30 and expire(spark, root, hours=0) == 0
    assert sorted(r.id for r in st.read_batches(spark, root).collect()) == list(range(300))
    # a batch that is replayed after it was covered and expired does not count again
    write_batch(spark.range(290, 300), root, 29, "batch", "w")
    assert st.read_batches(spark, root).count() == 300
    write_batch(spark.range(300, 305), root, 30, "batch", "w")
    assert compact(spark, root, fanout=3) == 30 and st.read_batches(spark, root).count() == 305


def test_parts_of_older_tables_and_of_two_runs_at_once(spark):
    """Parts named without their start are folded like others; of nested ranges the larger counts."""
    from ledgerline.sources.feeds import COMPACTED, _write, compact, folders, write_batch
    root = f"{fresh_dir(spark, 'older-parts')}/t"
    for n in (3, 5):
        _write(spark.range(n), root, f"{root}/{COMPACTED}/batch_upto={n}-w")
    write_batch(spark.range(100, 101), root, 6, "batch", "w")
    assert st.read_batches(spark, root).count() == 9
    assert compact(spark, root, fanout=3) == 6 and st.read_batches(spark, root).count() == 9
    (only,) = folders(spark, root)[0]["batch", "w"]
    assert (only.start, only.end, only.level) == (0, 6, 1)
    # a run that saw batch 7 alone, beside one that saw 7 and 8
    _write(spark.range(1), root, f"{root}/{COMPACTED}/batch_upto=7_from=7_level=0-w")
    _write(spark.range(2), root, f"{root}/{COMPACTED}/batch_upto=8_from=7_level=0-w")
    assert st.read_batches(spark, root).count() == 11
    # runs that saw one range, one of them with more parts to fold
    _write(spark.range(2), root, f"{root}/{COMPACTED}/batch_upto=8_from=7_level=1-w")
    assert st.read_batches(spark, root).count() == 11
