"""Command line for spark-submit: ``python -m ledgerline <command> ...``.

Commands
  build        materialise the models (tables + views) under --out
  test         evaluate the 20 data-quality checks; non-zero exit on failure
  load-csv     load a directory of CSV files into a table (sanitised names)
  ingest       stream keyed tick messages (Kafka topic or message files) into a table
  recent       stream landed API responses; append the newest N bars of each response
  live-rollup  keep the daily OHLCV and latest-tick changelogs up to date
  compact      fold a live-rollup changelog into a snapshot, or merge the
               per-batch folders of a recent / dual-sink table (bounded reads)

Raw tables are read from --raw (``<raw>/<table>`` in --raw-format) or, with
--fixtures <sf_dir>, derived from the driver tables.  Streams default to the
5-minute cadence; --replay drains what is available and stops.
"""

from __future__ import annotations

import argparse
import json
import sys

from ledgerline.session import build_session


def _warehouse(spark, args):
    from ledgerline.sources.catalog import TableSources, Warehouse
    from ledgerline.sources.fixtures import FixtureSources
    src = (FixtureSources(spark, args.fixtures) if args.fixtures
           else TableSources(spark, args.raw, args.raw_format))
    from ledgerline.sources.typed import TypedSources
    return Warehouse(spark, TypedSources(src), params={"economy_country": args.country})


def _trigger(args):
    from ledgerline.streaming.ticks import LIVE, REPLAY
    return REPLAY if args.replay else LIVE


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerline", description=__doc__.split("\n\n")[0],
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--master", default=None, help="only for local runs; spark-submit sets it")
    p.add_argument("--shuffle-partitions", type=int, default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    def with_sources(sp):
        sp.add_argument("--raw", help="folder holding one sub-folder per raw table")
        sp.add_argument("--raw-format", default="parquet")
        sp.add_argument("--fixtures", help="driver-table folder to derive the raw tables from")
        sp.add_argument("--country", default="United States", help="economy mart country")

    b = sub.add_parser("build", help="materialise the models (tables + views)")
    with_sources(b)
    b.add_argument("--out", default="", help="folder for file tables (--format parquet)")
    b.add_argument("--format", default="parquet", help="parquet (files under --out) or table (catalog)")
    b.add_argument("--database", help="catalog database for --format table")
    b.add_argument("--since", help="YYYY-MM-DD: rebuild date-partitioned tick facts from this day on")
    b.add_argument("--buckets", type=int, default=0,
                   help="bucket the (symbol, date) facts (--format table) for shuffle-free joins")
    b.add_argument("--models", nargs="*")
    b.add_argument("--include-disabled", action="store_true")
    b.add_argument("--test", action="store_true", help="run the data-quality checks afterwards")

    t = sub.add_parser("test", help="run the 20 data-quality checks")
    with_sources(t)

    c = sub.add_parser("load-csv", help="load a CSV directory into a table")
    c.add_argument("path")
    c.add_argument("target")
    c.add_argument("--format", default="parquet")
    c.add_argument("--export-root")
    c.add_argument("--strict", action="store_true", help="check every file's header")
    c.add_argument("--schema", help="DDL schema (e.g. 'Date date, Close double'); skips the inference pass")

    k = sub.add_parser("compact", help="fold a stream's changelog / batch folders")
    k.add_argument("root", help="a changelog (e.g. <live-rollup out>/daily_ohlcv) or a batch table")
    k.add_argument("--keys", nargs="+", help=argparse.SUPPRESS)  # of older scripts; the changelog knows its keys
    k.add_argument("--batches", action="store_true", help="root is an append-only batch table")
    k.add_argument("--expire-hours", type=float, help="then delete folders that a compacted part has covered for so long")

    helps = {"ingest": "stream tick messages into a table",
             "recent": "stream API responses; append the newest N bars of each response",
             "live-rollup": "keep the daily OHLCV and latest tick up to date"}
    for name in ("ingest", "recent", "live-rollup"):
        s = sub.add_parser(name, help=helps[name])
        s.add_argument("source", help="topic name, or folder of message / response / tick files")
        s.add_argument("out")
        s.add_argument("--checkpoint", required=True, help="shared checkpoint folder")
        s.add_argument("--replay", action="store_true")
        s.add_argument("--max-files-per-trigger", type=int,
                       help="bound each micro-batch when reading files")
        if name == "ingest":
            s.add_argument("--max-offsets-per-trigger", type=int,
                           help="bound each micro-batch when reading Kafka")
            s.add_argument("--kafka-servers", help="bootstrap servers; files when omitted")
        if name in ("ingest", "recent"):
            s.add_argument("--dead-letter", help="table of what could not be read")
        if name == "recent":
            s.add_argument("-n", type=int, default=5)
            s.add_argument("--fallback", help="folder for CSV files of micro-batches that the table does not take")
        if name == "live-rollup":
            s.add_argument("--delay", default="1 day")
            s.add_argument("--daily-output", choices=("changelog", "closed"), default="changelog",
                           help="changelog: every update; closed: final bars once per day")

    args = p.parse_args(argv)
    spark = build_session(args.master, args.shuffle_partitions)

    if args.cmd == "build":
        from ledgerline.plans import runner
        wh = _warehouse(spark, args)
        fn = runner.build_and_test if args.test else runner.build
        if args.format != "table" and not args.out:
            p.error("build needs --out for file tables")
        out = fn(wh, args.out, names=args.models, include_disabled=args.include_disabled,
                 fmt=args.format, buckets=args.buckets, database=args.database,
                 since=args.since)
        print(json.dumps(out))
    elif args.cmd == "test":
        from ledgerline.operators import quality
        wh = _warehouse(spark, args)
        rows = [r.asDict() for r in quality.run_checks(wh).collect()]  # one row per check
        warnings = [r.asDict() for r in quality.run_checks(wh, quality.WARNINGS).collect()]
        print(json.dumps({"checks": rows, "warnings": warnings}))
        return 1 if any(r["failures"] for r in rows) else 0
    elif args.cmd == "compact":
        from ledgerline.sources.feeds import expire
        from ledgerline.streaming.ticks import compact_batches, compact_changelog
        upto = (compact_batches(spark, args.root) if args.batches
                else compact_changelog(spark, args.root))
        done = {"compacted_upto": upto}
        if args.expire_hours is not None:
            done["expired"] = expire(spark, args.root, args.expire_hours)
        print(json.dumps(done))
    elif args.cmd == "load-csv":
        from ledgerline.operators.sinks import static_load
        from ledgerline.sources.files import csv_dir_scan
        n = static_load(csv_dir_scan(spark, args.path, schema=args.schema, strict=args.strict), args.target,
                        args.format, export_root=args.export_root)
        print(json.dumps({"rows": n, "target": args.target}))
    else:
        from ledgerline.schemas import TICK_SPLIT_SCHEMA
        from ledgerline.streaming import ticks as st
        trig = _trigger(args)
        file_opts = ({"maxFilesPerTrigger": str(args.max_files_per_trigger)}
                     if args.max_files_per_trigger else {})
        queries = []
        if args.cmd == "ingest":
            kafka = {"kafka.bootstrap.servers": args.kafka_servers} if args.kafka_servers else None
            if kafka and args.max_offsets_per_trigger:
                kafka["maxOffsetsPerTrigger"] = str(args.max_offsets_per_trigger)
            fmt = "kafka" if kafka else "files"
            opts = kafka if kafka else file_opts
            messages = st.message_stream(spark, args.source, fmt, opts)
            if args.dead_letter:
                queries.append(st.ingest_and_reject(messages, args.out, args.dead_letter, f"{args.checkpoint}/ingest", trig))
            else:
                queries.append(st.ingest_ticks(messages, args.out, f"{args.checkpoint}/ingest", trig))
        elif args.cmd == "recent":
            queries.append(st.recent_append(st.response_stream(spark, args.source, file_opts), args.out,
                                            f"{args.checkpoint}/recent", args.n, trig, args.fallback))
            if args.dead_letter:
                queries.append(st.dead_letter_responses(
                    st.response_stream(spark, args.source, file_opts), args.dead_letter,
                    f"{args.checkpoint}/dead_letter", trig))
        else:
            ticks = st.tick_file_stream(spark, args.source, TICK_SPLIT_SCHEMA, file_opts)
            queries.append(st.daily_ohlcv_stream(ticks, f"{args.out}/daily_ohlcv",
                                                 f"{args.checkpoint}/daily_ohlcv", args.delay, trig,
                                                 output=args.daily_output))
            queries.append(st.latest_tick_stream(st.tick_file_stream(spark, args.source,
                                                                     TICK_SPLIT_SCHEMA, file_opts),
                                                 f"{args.out}/latest_tick",
                                                 f"{args.checkpoint}/latest_tick", trig))
        if args.replay:
            for q in queries:
                st.run_to_end(q)
        else:
            # Live: return (with the error) as soon as any of the queries stops.
            spark.streams.awaitAnyTermination()
            for q in queries:
                if q.exception():
                    raise q.exception()
    return 0


if __name__ == "__main__":
    sys.exit(main())
