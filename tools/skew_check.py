"""Hot-key check: one symbol holding a third of all ticks.

Usage: python tools/skew_check.py [sf_dir] [map_tasks]

``map_tasks`` > 1 first spreads the ticks round-robin over that many
partitions, standing in for the many input splits of a large table (the
driver files are single row groups, i.e. one map task).

Re-keys the driver's ticks so that every event with ``user_id % 3 == 0``
belongs to one symbol ("HOT"), runs the daily rollup, the latest tick per
symbol and the top-5 per symbol with Spark's event log written to a scratch
folder, and reports for each the input rows, the records shuffled and the
most records any single post-shuffle task read.  With map-side combining
the last number tracks groups x map tasks, not the hot symbol's rows.
"""
from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    map_tasks = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    log_dir = tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    from pyspark.sql import functions as F

    from ledgerline.operators.rollup import daily_ohlcv
    from ledgerline.operators.topk import latest_per_key, newest_per_key
    from ledgerline.plans.queries import fixture_warehouse
    from ledgerline.session import build_session
    spark = build_session("local[8]", 8, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    wh = fixture_warehouse(spark, sf)
    events = wh.resolver.table("events").select("event_id", "user_id")
    ticks = (wh.source("realtime_test_stock_data").join(events, "event_id")
             .withColumn("symbol", F.when(F.col("user_id") % 3 == 0, F.lit("HOT"))
                         .otherwise(F.col("symbol")))
             .drop("user_id", "event_id"))
    if map_tasks > 1:
        # Materialised once, so the measured jobs start from map_tasks
        # partitions and only their own shuffle is counted.
        ticks = ticks.repartition(map_tasks).persist()
        ticks.count()
    runs = {
        "daily_ohlcv": daily_ohlcv(ticks),
        "latest_per_key": latest_per_key(ticks, "symbol", "timestamp", ["close", "volume"]),
        "newest_per_key(5)": newest_per_key(ticks, "symbol", 5),
    }
    hot_rows = ticks.where("symbol = 'HOT'").count()
    total = ticks.count()
    for name, df in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_query: dict[int, str] = {}
    stats: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    for path in [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)]:
        with open(path) as fh:
            events_ = [json.loads(line) for line in fh]
        for ev in events_:
            if ev["Event"] == "SparkListenerJobStart":
                for sid in ev.get("Stage IDs", []):
                    stage_query[sid] = (ev.get("Properties") or {}).get("spark.jobGroup.id")
        for ev in events_:
            if ev["Event"] != "SparkListenerTaskEnd":
                continue
            q = stage_query.get(ev["Stage ID"])
            m = ev.get("Task Metrics") or {}
            if q not in runs or not m:
                continue
            read = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            stats[q]["shuffled"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
            stats[q]["max_task_shuffle_read"] = max(stats[q]["max_task_shuffle_read"], read)

    print(f"event log: {log_dir}")
    print(f"ticks: {total:,}; hot symbol: {hot_rows:,} ({hot_rows / total:.0%}); map tasks: {map_tasks}")
    print("| operator | records shuffled | most records read by one post-shuffle task |")
    print("| --- | --- | --- |")
    for name in runs:
        s = stats[name]
        print(f"| `{name}` | {s['shuffled']:,} | {s['max_task_shuffle_read']:,} |")


if __name__ == "__main__":
    main()
