"""The spark-submit entry point, run in-process against the test session."""
import json

from ledgerline import cli
from ledgerline.plans.queries import fixture_warehouse
from ledgerline.session import fresh_dir
from ledgerline.sources import landing
from tests.conftest import SF_SMALL


def test_load_csv_command(spark, capsys):
    raw = fixture_warehouse(spark, SF_SMALL).source("global_economy_indicators")
    src = landing.land_csv(raw, fresh_dir(spark, "cli-csv"),
                           {"Gross_Domestic_Product_GDP": "Gross Domestic Product (GDP)"})
    target = fresh_dir(spark, "cli-load") + "/economy"
    assert cli.main(["load-csv", src, target]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows"] == raw.count()
    assert spark.read.parquet(target).columns == ["Year", "Country", "Gross_Domestic_Product_GDP"]
    # with a schema there is no inference pass, and the header names still sanitise
    typed = fresh_dir(spark, "cli-load-typed") + "/economy"
    assert cli.main(["load-csv", src, typed, "--schema",
                     "`Year` int, `Country` string, `Gross Domestic Product (GDP)` double"]) == 0
    assert spark.read.parquet(typed).schema == spark.read.parquet(target).schema


def test_ingest_command_replays_topic_files(spark):
    ticks = fixture_warehouse(spark, SF_SMALL).ref("stg_test_realtime_stock_data")
    topic = landing.land_messages(ticks, fresh_dir(spark, "cli-topic"))
    out = fresh_dir(spark, "cli-ingest")
    assert cli.main(["ingest", topic, f"{out}/table", "--checkpoint", f"{out}/_ck",
                     "--dead-letter", f"{out}/dlq", "--replay", "--max-files-per-trigger", "1"]) == 0
    assert spark.read.parquet(f"{out}/table").count() == ticks.count()
    assert spark.read.parquet(f"{out}/dlq").count() == 0


def test_recent_and_live_rollup_commands(spark):
    from ledgerline.streaming import ticks as st
    wh = fixture_warehouse(spark, SF_SMALL)
    responses = landing.land_responses(wh.source("tick_events"), fresh_dir(spark, "cli-resp"))
    out = fresh_dir(spark, "cli-recent")
    assert cli.main(["recent", responses, f"{out}/table", "--checkpoint", f"{out}/_ck",
                     "-n", "2", "--replay"]) == 0
    assert cli.main(["compact", f"{out}/table", "--batches"]) == 0
    recent = st.read_batches(spark, f"{out}/table")
    asked = spark.read.json(responses).select("symbol", "request_id").distinct().count()
    assert 0 < recent.count() <= 2 * asked  # the newest two of each response
    assert recent.select("symbol").distinct().count() == 15

    ticks = fresh_dir(spark, "cli-ticks")
    wh.ref("stg_test_realtime_stock_data").write.mode("overwrite").parquet(ticks)
    live = fresh_dir(spark, "cli-live")
    assert cli.main(["live-rollup", ticks, live, "--checkpoint", f"{live}/_ck", "--replay"]) == 0
    daily = st.read_daily(spark, f"{live}/daily_ohlcv")
    assert daily.count() == wh.ref("int_daily_stock_summary").count()
    assert st.read_latest(spark, f"{live}/latest_tick").count() == 15
    assert cli.main(["compact", f"{live}/latest_tick", "--keys", "symbol"]) == 0
    assert st.read_latest(spark, f"{live}/latest_tick").count() == 15


def test_test_command_reports_checks_and_warnings(spark, capsys):
    assert cli.main(["test", "--fixtures", SF_SMALL, "--country", "NATION_0"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(out["checks"]) == 20 and all(r["failures"] == 0 for r in out["checks"])
    assert [r["test_id"] for r in out["warnings"]] == ["W-sp500"]
