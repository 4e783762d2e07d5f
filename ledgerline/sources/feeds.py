"""Feed tables: one table that several batch and stream writers append to.

Layout under the table's root:

* ``<feed>_id=<n>-<writer>/``: micro-batch ``n`` of one stream writer; a
  replayed batch replaces its own folder;
* ``append=<name>/``: one batch append;
* ``_compacted/<feed>_upto=<n>_from=<m>_level=<k>-<writer>/``: the writer's
  batches ``m`` to ``n`` in larger files (older tables: ``<feed>_upto=<n>-<writer>``,
  from the previous part on);
* ``_log/<folder>``: an empty entry for each complete folder;
* Parquet files right under the root: rows of a plain append.

The writer's name is drawn once per checkpoint and kept in it, so two queries
of one kind, or one restarted from a fresh checkpoint, never share a folder,
and a late writer's batches are not taken for compacted ones.

A folder counts once the log has it, whatever markers the committer leaves
(folders of tables without a log count by their ``_SUCCESS`` file).  Readers
name the folders they read, so they need neither partition discovery nor a
stream's file log, see every writer's rows, and work when compacted batches
have been expired.  A compaction only ever writes a new folder, from the
batches that no part covers yet; with nothing new it does nothing.

Parts have levels.  A run that would leave ``fanout`` parts of one level folds
them into its own, one level up, so after R runs a writer has at most
``fanout - 1`` parts on each of about log(R) levels, and a row is rewritten
about log(R) times.  A part inside the range of another does not count any
more: its place is taken by one log entry, and two runs at once cannot make
rows count twice.  ``expire`` deletes what has been covered for a while.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

COMPACTED, LOG = "_compacted", "_log"
#: Name of the file in a checkpoint that holds its writer's name.
WRITER_FILE = "ledgerline_writer"
#: Size that compacted files aim at.
FILE_BYTES = 256 << 20
#: Parts of one level that are folded into one of the next.
FANOUT = 8

#: A stream writer of a table: its feed and its name ("" in tables of before writers had names).
Writer = tuple[str, str]


class Part(NamedTuple):
    """A compacted folder: a writer's batches ``start`` to ``end`` (``start`` None: an older table's, from the part before)."""

    end: int
    start: int | None
    level: int
    name: str

    def covers(self, batch: int) -> bool:
        return batch <= self.end and (self.start is None or self.start <= batch)

    def within(self, other: Part) -> bool:
        """Whether ``other`` holds all rows of this part."""
        if other.start is None:
            return False
        start = self.end if self.start is None else self.start
        wider = other.start < start or self.end < other.end or (self.start is None) or other > self  # of equal ranges one counts
        return other.start <= start and self.end <= other.end and wider


def _folder(writer: Writer, kind: str, n: int) -> str:
    feed, name = writer
    return f"{feed}_{kind}={n}" + (f"-{name}" if name else "")


def batch_dir(root: str, batch_id: int, feed: str = "batch", writer: str = "") -> str:
    return f"{root.rstrip('/')}/{_folder((feed, writer), 'id', batch_id)}"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the writer that ``checkpoint`` belongs to, drawn at its first use."""
    fs, p = _file_system(spark, f"{checkpoint.rstrip('/')}/{WRITER_FILE}")
    if not fs.exists(p):
        out = fs.create(p, False)  # fails if another driver was faster
        out.writeUTF(uuid.uuid4().hex[:16])
        out.close()
    source = fs.open(p)
    try:
        return source.readUTF()
    finally:
        source.close()


def _entries(spark: SparkSession, path: str) -> list:
    fs, p = _file_system(spark, path)
    return list(fs.listStatus(p)) if fs.exists(p) else []


def _entry(spark: SparkSession, root: str, name: str):
    return _file_system(spark, f"{root.rstrip('/')}/{LOG}/{name}")


def _complete(spark: SparkSession, root: str, under: str, logged: set[str]) -> list[str]:
    """Names of the complete folders right under ``under`` (one listing, no file names)."""
    names = []
    for s in _entries(spark, under):
        name = s.getPath().getName()
        if s.isDirectory() and not name.startswith(("_", ".")):
            fs, marker = _file_system(spark, f"{under}/{name}/_SUCCESS")
            if name in logged or fs.exists(marker):
                names.append(name)
    return names


def _parts(names: list[str]) -> dict[Writer, list[Part]]:
    """The parts among folder names, by writer."""
    parts: dict[Writer, list[Part]] = {}
    for name in names:
        if m := re.fullmatch(r"(\w+?)_upto=(\d+)(?:_from=(\d+)_level=(\d+))?(?:-(\w+))?", name):
            start = None if m[3] is None else int(m[3])
            parts.setdefault((m[1], m[5] or ""), []).append(Part(int(m[2]), start, int(m[4] or 0), name))
    return parts


def _batch(name: str) -> tuple[Writer, int] | None:
    m = re.fullmatch(r"(\w+)_id=(\d+)(?:-(\w+))?", name)
    return ((m[1], m[3] or ""), int(m[2])) if m else None


def _live(parts: list[Part]) -> list[Part]:
    """The parts that no other one replaces, oldest first."""
    return sorted(p for p in parts if not any(p.within(q) for q in parts))


def folders(spark: SparkSession, root: str) -> tuple[dict[Writer, list[Part]], dict[Writer, list[int]], list[str]]:
    """(parts that count by writer, uncovered batch ids by writer, append folders), each in order."""
    root = root.rstrip("/")
    logged = {s.getPath().getName() for s in _entries(spark, f"{root}/{LOG}")}
    parts = {w: _live(found) for w, found in _parts(_complete(spark, root, f"{root}/{COMPACTED}", logged)).items()}
    batches: dict[Writer, list[int]] = {}
    appends = []
    for name in _complete(spark, root, root, logged):
        if found := _batch(name):
            writer, n = found
            if not any(p.end >= n for p in parts.get(writer, [])):
                batches.setdefault(writer, []).append(n)
        elif name.startswith("append="):
            appends.append(name)
    return parts, {k: sorted(v) for k, v in batches.items()}, sorted(appends)


def _paths(spark: SparkSession, root: str) -> list[str]:
    """What a reader reads: folders, and the files of plain appends beside them."""
    root = root.rstrip("/")
    parts, batches, appends = folders(spark, root)
    found = ([f"{root}/{COMPACTED}/{p.name}" for ps in parts.values() for p in ps]
             + [f"{root}/{_folder(w, 'id', n)}" for w, ids in batches.items() for n in ids]
             + [f"{root}/{name}" for name in appends])
    if not found:
        return []
    names = [s.getPath().getName() for s in _entries(spark, root) if s.isFile()]
    return found + [f"{root}/{name}" for name in names if name.endswith(".parquet") and not name.startswith(("_", "."))]


def _write(df: DataFrame, root: str, folder: str) -> None:
    """Replace one folder and log it; readers do not see it meanwhile."""
    name = folder.rstrip("/").rsplit("/", 1)[-1]
    fs, entry = _entry(df.sparkSession, root, name)
    fs.delete(entry, False)
    df.write.mode("overwrite").parquet(folder)
    fs.create(entry, True).close()


def write_batch(df: DataFrame, root: str, batch_id: int, feed: str = "batch", writer: str = "") -> None:
    """A stream writer's micro-batch; a replayed one replaces itself."""
    _write(df, root, batch_dir(root, batch_id, feed, writer))


def drop_batch(spark: SparkSession, root: str, batch_id: int, feed: str = "batch", writer: str = "") -> None:
    """Take back a micro-batch that no part covers yet: its log entry, then its folder."""
    path = batch_dir(root, batch_id, feed, writer)
    fs, entry = _entry(spark, root, path.rsplit("/", 1)[-1])
    fs.delete(entry, False)
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def is_feed_table(spark: SparkSession, root: str) -> bool:
    return bool(_paths(spark, root))


def read_batches(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """All rows of a feed table.  With ``schema``, an empty table while nothing is written."""
    paths = _paths(spark, root)
    if not paths:
        if schema is None:
            raise FileNotFoundError(f"no batch written under {root!r} yet; pass schema= to get an empty table")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(*paths)


def append_rows(df: DataFrame, root: str, name: str | None = None) -> str:
    """Append a batch job's rows; a repeated ``name`` replaces its own rows."""
    path = f"{root.rstrip('/')}/append={name or uuid.uuid4().hex}"
    _write(df, root, path)
    return path


def compact(spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame] | None = None,
            file_bytes: int = FILE_BYTES, fanout: int = FANOUT) -> int | None:
    """Fold each writer's uncovered batches into a new part; the largest end, None without batches.

    The new part also takes in the newest parts of its level if it is the
    ``fanout``-th of them, and so on up the levels; it is written once, from
    all of them.  Larger, older parts stay as they are.  ``merge`` combines
    the rows of the folded batches (partial aggregates).  The files' number
    follows the bytes folded.  A run that was cut short is not in the log and
    is written again.
    """
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    root = root.rstrip("/")
    parts, batches, _ = folders(spark, root)
    for writer, ids in batches.items():
        older, folded, level = parts.get(writer, []), [], 0
        while len(same := [p for p in older if p.level == level]) >= fanout - 1:
            # levels fall from old to new, so these are the newest parts left
            older, folded, level = [p for p in older if p.level != level], same + folded, level + 1
        start = max((p.end for p in older), default=-1) + 1
        paths = ([f"{root}/{COMPACTED}/{p.name}" for p in folded] + [f"{root}/{_folder(writer, 'id', n)}" for n in ids])
        size = 0
        for path in paths:
            fs, p = _file_system(spark, path)
            size += fs.getContentSummary(p).getLength()
        rows = spark.read.parquet(*paths)
        rows = merge(rows) if merge else rows
        feed, name = writer
        part = f"{feed}_upto={ids[-1]}_from={start}_level={level}" + (f"-{name}" if name else "")
        _write(rows.coalesce(max(1, -(-size // file_bytes))), root, f"{root}/{COMPACTED}/{part}")
    ends = [p.end for ps in parts.values() for p in ps] + [n for ids in batches.values() for n in ids]
    return max(ends) if ends else None


def expire(spark: SparkSession, root: str, hours: float = 24.0) -> int:
    """Delete batches and parts whose rows another part has held for ``hours``; the number of folders deleted.

    ``hours`` must be longer than any reader or writer of the table takes: a
    reader names its folders when it starts.  A folder's log entry goes first;
    what a cut-short run leaves is deleted by the next one.  Only parts in the
    log let anything go.
    """
    root = root.rstrip("/")
    before = (time.time() - hours * 3600) * 1000
    old = [s.getPath().getName() for s in _entries(spark, f"{root}/{LOG}") if s.getModificationTime() <= before]
    holders = _parts(old)
    listed = lambda path: [s.getPath().getName() for s in _entries(spark, path) if s.isDirectory()]
    present = set(listed(f"{root}/{COMPACTED}"))
    holders = {w: [p for p in ps if p.name in present] for w, ps in holders.items()}
    gone = [f"{COMPACTED}/{p.name}" for w, ps in _parts(sorted(present)).items() for p in ps
            if any(p.within(q) for q in holders.get(w, []))]
    for name in listed(root):
        if (found := _batch(name)) and any(p.covers(found[1]) for p in holders.get(found[0], [])):
            gone.append(name)
    for name in gone:
        fs, entry = _entry(spark, root, name.rsplit("/", 1)[-1])
        fs.delete(entry, False)
        fs, folder = _file_system(spark, f"{root}/{name}")
        fs.delete(folder, True)
    return len(gone)
