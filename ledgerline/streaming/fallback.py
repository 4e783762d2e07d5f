"""A stream into a primary sink that may fail, with a CSV fallback per micro-batch.

Layout under the fallback root:

* ``batch=<n>-<writer>/``: CSV files of a batch that the primary did not take;
* ``_routes/<n>-<writer>-<route>``: an empty record, written when batch ``n``
  is complete; its route is ``primary`` or ``fallback``.

A replayed batch with a record is complete and does nothing.  One without
(the driver died in between) is written again: a fallback folder is replaced,
and read only if its record says so.  With a feed table as the primary a
batch therefore counts exactly once, wherever the run was cut: its folder
there is replaced, or taken back when the second attempt ends in the fallback.
A connector that only appends may hold a batch twice if the driver dies
between its load and the record.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators import sinks
from ledgerline.sources.feeds import _entries, _file_system, drop_batch, write_batch, writer_of

log = logging.getLogger(__name__)

PRIMARY, FALLBACK = "primary", "fallback"
ROUTES = "_routes"

#: Loads a batch (rows, its number, the writer's name); raising sends the batch to the fallback.
Load = Callable[[DataFrame, int, str], object]
#: Takes a batch (its number, the writer's name) back from the primary.
Undo = Callable[[SparkSession, int, str], None]


def feed_primary(root: str, feed: str = "batch") -> tuple[Load, Undo]:
    """A feed table as the primary: (load, undo)."""
    return (lambda df, n, writer: write_batch(df, root, n, feed, writer),
            lambda spark, n, writer: drop_batch(spark, root, n, feed, writer))


def connector_primary(target: str, fmt: str, options: Mapping[str, str] | None = None) -> tuple[Load, Undo]:
    """A connector that appends: (load, undo); it cannot take a batch back."""
    return lambda df, n, writer: sinks.append_sink(df, target, fmt, options), lambda spark, n, writer: None


def routes(spark: SparkSession, fallback_root: str) -> dict[tuple[str, int], str]:
    """The route of every complete batch, by (writer, number)."""
    found = {}
    for s in _entries(spark, f"{fallback_root.rstrip('/')}/{ROUTES}"):
        if m := re.fullmatch(r"(\d+)-(\w+)-(primary|fallback)", s.getPath().getName()):
            found[m[2], int(m[1])] = m[3]
    return found


def _batch_folder(root: str, n: int, writer: str) -> str:
    return f"{root.rstrip('/')}/batch={n}-{writer}"


def routed_writer(primary: tuple[Load, Undo], fallback_root: str, checkpoint: str,
                  rows: Callable[[DataFrame], DataFrame] = lambda df: df,
                  csv_options: Mapping[str, str] | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch body that loads ``rows`` of each batch into ``primary``, or else into CSV files."""
    load, undo = primary

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        writer = writer_of(spark, checkpoint)
        if (writer, batch_id) in routes(spark, fallback_root):
            return
        out, route = rows(df), PRIMARY
        try:
            load(out, batch_id, writer)
        except Exception as e:  # noqa: BLE001 - any failure of the sink triggers the fallback
            log.error("batch %d not loaded (%s); writing CSV files", batch_id,
                      str(e).splitlines()[0] if str(e) else type(e).__name__)
            undo(spark, batch_id, writer)
            route = FALLBACK
            (out.write.mode("overwrite").option("header", True).options(**dict(csv_options or {}))
             .csv(_batch_folder(fallback_root, batch_id, writer)))
        fs, record = _file_system(spark, f"{fallback_root.rstrip('/')}/{ROUTES}/{batch_id}-{writer}-{route}")
        fs.create(record, True).close()
    return write


def routed_append(rows: DataFrame, primary: tuple[Load, Undo], fallback_root: str, checkpoint: str,
                  trigger: Mapping, csv_options: Mapping[str, str] | None = None) -> StreamingQuery:
    """Append a stream to ``primary``, each micro-batch it does not take to CSV files."""
    return (rows.writeStream.option("checkpointLocation", checkpoint).trigger(**dict(trigger))
            .foreachBatch(routed_writer(primary, fallback_root, checkpoint, csv_options=csv_options)).start())


def read_fallback(spark: SparkSession, fallback_root: str, schema,
                  csv_options: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of the batches that went to the fallback (for a later load)."""
    paths = sorted(_batch_folder(fallback_root, n, writer)
                   for (writer, n), route in routes(spark, fallback_root).items() if route == FALLBACK)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).options(**dict(csv_options or {})).csv(paths)
