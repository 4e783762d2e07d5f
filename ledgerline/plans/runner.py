"""Build the models: materialise tables, register views, run the checks.

``build`` walks the models in dependency order (the order ``ref`` resolves
them).  A ``table`` model is written with overwrite to
``<root>/<model>`` (or saved as a catalog table) and then *pinned*: later
``ref`` calls read the written table, so downstream plans start from stored
files instead of recomputing the upstream lineage.  A ``view`` model is
registered as a temporary view and stays lazy.
"""

from __future__ import annotations

from collections.abc import Iterable

import logging

from ledgerline.operators import quality
from ledgerline.plans.registry import MODELS
from ledgerline.sources.catalog import Warehouse

# Tick-grain tables are written partitioned by day so date-range reads prune
# files.  The rows are rebalanced on the day first, so that a day has files of
# about the advisory partition size instead of one per task: AQE splits a hot
# day over several tasks and merges small ones.  ``max_records_per_file``
# bounds a file besides.
PARTITION_BY = {"fact_stock_tick": ("date",)}

# Date-partitioned tables that can be rebuilt from a day onwards: the model's
# raw timestamp column (the filter reaches the scan) whose calendar day is
# the partition value, so every row of a rebuilt day passes the filter.
INCREMENTAL = {"fact_stock_tick": "timestamp"}

# (symbol, date)-grain facts are bucketed on their key when written to the
# catalog, so joining them to each other needs no shuffle.
BUCKET_BY = {"fact_daily_summary": ("symbol", "date"),
             "fact_daily_features": ("symbol", "date")}


def build(wh: Warehouse, root: str, names: Iterable[str] | None = None,
          fmt: str = "parquet", include_disabled: bool = False,
          register_views: bool = True,
          max_records_per_file: int = 20_000_000,
          buckets: int = 0, database: str | None = None,
          since=None) -> dict[str, int | None]:
    """Materialise ``names`` (default: every enabled model).

    ``fmt="table"`` saves catalog tables (in ``database`` if given); with
    ``buckets`` > 0 the (symbol, date)-grain facts are bucketed into that
    many buckets.  Returns ``{model: rows written}`` for tables and
    ``{view: None}``.

    ``since`` (a date): the date-partitioned tables in ``INCREMENTAL`` are
    rebuilt only from that day on (dynamic partition overwrite; older day
    folders are left as they are); every other table is rebuilt fully.
    """
    rank = {"staging": 0, "intermediate": 1, "facts": 2, "dimensions": 3, "marts": 4}
    wanted = list(names) if names is not None else [
        n for n, m in sorted(MODELS.items(), key=lambda kv: rank[kv[1].layer])
        if include_disabled or m.enabled]
    done: dict[str, int | None] = {}
    for name in wanted:
        _build_one(wh, name, root.rstrip("/"), fmt, register_views, done, max_records_per_file,
                   buckets, database, since)
    return done


def _build_one(wh, name, root, fmt, register_views, done, max_records_per_file,
               buckets=0, database=None, since=None):
    if name in done:
        return
    from ledgerline.operators.sinks import write_table
    m = MODELS[name]
    df = wh.ref(name)
    if m.materialized == "table":
        table = f"{database}.{name}" if database else name
        target = table if fmt == "table" else f"{root}/{name}"
        bucket = ((buckets, BUCKET_BY[name]) if fmt == "table" and buckets and name in BUCKET_BY
                  else None)
        options = {"maxRecordsPerFile": str(max_records_per_file)}
        if since is not None and name in INCREMENTAL:
            from pyspark.sql import functions as F
            start = F.lit(str(since)).cast("date").cast(df.schema[INCREMENTAL[name]].dataType)
            df = df.where(F.col(INCREMENTAL[name]) >= start)
            options["partitionOverwriteMode"] = "dynamic"
        if name in PARTITION_BY:
            df = df.hint("rebalance", *PARTITION_BY[name])
        done[name] = write_table(df, target, "overwrite", fmt, options,
                                 PARTITION_BY.get(name, ()), bucket)
        stored = wh.spark.table(table) if fmt == "table" else wh.spark.read.format(fmt).load(target)
        wh.pin(name, stored)
    else:
        if register_views:
            df.createOrReplaceTempView(name)
        done[name] = None


log = logging.getLogger(__name__)


def build_and_test(wh: Warehouse, root: str, **kw) -> dict[str, int | None]:
    """``build`` then evaluate the declared data-quality checks on the built
    models; raises if any check fails.  Warning-level checks (e.g. a
    non-unique S&P date that would fan out the daily marts' left join) are
    logged, not raised."""
    built = build(wh, root, **kw)
    checks = [c for c in quality.CHECKS if c.model in built]
    quality.assert_passing(quality.run_checks(wh, checks))
    for r in quality.run_checks(wh, quality.WARNINGS).where("failures > 0").collect():
        log.warning("check %s: %s(%s.%s) has %d failures", r.test_id, r.test, r.model,
                    r.column_name, r.failures)
    return built
