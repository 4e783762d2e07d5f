"""Sinks: append / truncate loads, schema-conformed appends, Parquet export,
fallback on failure, and the static load that ties them together.

Row counts come from an ``Observation`` attached to the write itself, so a
load executes its plan once (no second ``count()`` pass).
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.names import sanitize_columns

log = logging.getLogger(__name__)


def _counted(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    obs = Observation(label)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_table(df: DataFrame, target: str, mode: str = "append", fmt: str = "parquet",
                options: Mapping[str, str] | None = None,
                partition_by: tuple[str, ...] = (),
                bucket_by: tuple[int, tuple[str, ...]] | None = None) -> int:
    """Write ``df`` to ``target`` (a path, or a catalog table when
    ``fmt == "table"``); return the number of rows written.

    ``bucket_by=(n, cols)`` (catalog tables only) hash-buckets the table on
    ``cols`` so later joins / aggregations on them between tables with the
    same bucketing need no shuffle.  The rows are repartitioned on the same
    keys first, so each task writes one file per bucket it owns.
    """
    if bucket_by:
        n, cols = bucket_by
        df = df.repartition(n, *cols)
    counted, obs = _counted(df, "write")
    writer = counted.write.mode(mode).options(**dict(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "table":
        if bucket_by:
            writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
        writer.saveAsTable(target)
    else:
        writer.format(fmt).save(target)
    return int(obs.get.get("rows", 0))


def append_sink(df: DataFrame, target: str, fmt: str = "parquet",
                options: Mapping[str, str] | None = None) -> int:
    """Append rows to a table (warehouse connector, Parquet, ...).

    Files that lie beside the folders of a feed table are read with them.
    """
    return write_table(df, target, "append", fmt, options)


@contextmanager
def _kept(df: DataFrame, wanted: bool) -> Iterator[DataFrame]:
    """``df`` evaluated once although two writes read it: kept on the executors' disks meanwhile
    (a lost executor's share is evaluated again)."""
    if not wanted:
        yield df
        return
    kept = df.persist(StorageLevel.DISK_ONLY)
    try:
        yield kept
    finally:
        kept.unpersist()


def truncate_load(df: DataFrame, target: str, truncate: bool = True, fmt: str = "parquet",
                  export_root: str | None = None, options: Mapping[str, str] | None = None) -> int:
    """Replace the table's contents (``truncate=True``) or append to them;
    ``options`` go to the writer of the table.

    With ``export_root`` the loaded rows are also exported (best effort) as
    the Parquet dataset ``<export_root>/<table>``, replaced on every load.
    It is a directory of part files written in parallel, not a single file:
    one file would mean funnelling the table through one task.
    """
    with _kept(df, bool(export_root)) as rows:
        n = write_table(rows, target, "overwrite" if truncate else "append", fmt, options)
        if export_root:
            parquet_export(rows, export_root, target.rstrip("/").rsplit("/", 1)[-1], mode="overwrite")
    return n


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Reorder columns by name, cast to the target types, drop extras and
    NULL-fill missing nullable columns (``DataFrame.to``)."""
    return df.to(schema)


def schema_append(df: DataFrame, target: str, schema: StructType, fmt: str = "parquet") -> int:
    """Append a frame conformed to the table schema; an empty frame writes
    nothing and returns 0."""
    if df.isEmpty():
        return 0
    return append_sink(conform(df, schema), target, fmt)


def parquet_export(df: DataFrame, root: str, table: str, mode: str = "append") -> int | None:
    """Export to ``<root>/<table>`` as Parquet.  A failure is logged and
    returns None; it never fails the load that requested the export."""
    try:
        return write_table(df, f"{root.rstrip('/')}/{table}", mode, "parquet")
    except Exception as e:  # noqa: BLE001 - export is best effort by contract
        log.error("parquet export of %s failed: %s", table, e)
        return None


def with_fallback(df: DataFrame, target: str, fallback_dir: str, fmt: str = "parquet",
                  options: Mapping[str, str] | None = None,
                  fallback_options: Mapping[str, str] | None = None,
                  cache: bool = False) -> tuple[int, str]:
    """Append to the primary sink; if that fails, append the same rows as
    CSV under ``fallback_dir`` and report 0 rows loaded.

    Returns ``(rows_loaded_to_primary, where_the_rows_went)``.  By default
    the rows are recomputed for the fallback: the primary usually succeeds,
    and caching a large input just in case would cost memory and disk on
    every load.  ``cache=True`` persists them first (for expensive inputs
    whose primary sink fails often).
    """
    rows = df.persist() if cache else df
    try:
        return append_sink(rows, target, fmt, options), target
    except Exception as e:  # noqa: BLE001 - any sink failure triggers the fallback
        log.error("primary sink %s failed (%s); writing CSV fallback", target,
                  str(e).splitlines()[0] if str(e) else type(e).__name__)
        (rows.write.mode("append").option("header", True)
         .options(**dict(fallback_options or {})).csv(fallback_dir))
        return 0, fallback_dir
    finally:
        if cache:
            rows.unpersist()


def static_load(df: DataFrame, target: str, fmt: str = "parquet",
                export_root: str | None = None, table_name: str | None = None,
                options: Mapping[str, str] | None = None) -> int:
    """Sanitise column names, append, and optionally export to Parquet;
    ``options`` go to the writer of the table.

    The count is observed during the append; the export is a separate
    best-effort write of the same rows, which are evaluated once.
    """
    with _kept(sanitize_columns(df), bool(export_root)) as clean:
        n = append_sink(clean, target, fmt, options)
        if export_root:
            parquet_export(clean, export_root, table_name or target.rstrip("/").rsplit("/", 1)[-1])
    return n


def publish_messages(messages: DataFrame, topic: str, fmt: str = "kafka",
                     options: Mapping[str, str] | None = None) -> int:
    """Produce keyed messages (``key``, ``value`` columns) to a topic.

    ``fmt="kafka"`` needs ``kafka.bootstrap.servers`` in ``options``; any
    other format writes the messages as files under ``topic`` (a path), the
    stand-in used where no broker exists.
    """
    counted, obs = _counted(messages.select("key", "value"), "publish")
    if fmt == "kafka":
        counted.write.format("kafka").option("topic", topic).options(**dict(options or {})).save()
    else:
        counted.write.mode("append").format(fmt).options(**dict(options or {})).save(topic)
    return int(obs.get.get("rows", 0))
