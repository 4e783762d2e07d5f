"""File sources: CSV dataset directories, landed API responses, message files."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.functions.names import warehouse_identifier

# Case-insensitive '.csv' extension.
CSV_GLOB = "*.[cC][sS][vV]"

LANDED_RESPONSE_SCHEMA = "symbol string, request_id bigint, body string"
MESSAGE_FILE_SCHEMA = "key string, value string"


def csv_dir_scan(spark: SparkSession, path: str, schema: StructType | str | None = None,
                 strict: bool = False, sampling_ratio: float | None = None) -> DataFrame:
    """All CSV files under ``path`` (recursively) as one table.

    Files are combined by column *position* under the first file's header
    (the historical behaviour).  ``strict=True`` checks every file's header
    against the schema instead and fails on a reordered or renamed header.

    Schema inference costs an extra pass over the files; at scale pass
    ``schema`` (or a ``sampling_ratio``) so the scan is a single read.
    Raises ``FileNotFoundError`` when no CSV file exists under ``path``.
    """
    reader = (spark.read.option("header", True)
              .option("recursiveFileLookup", True)
              .option("pathGlobFilter", CSV_GLOB))
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
        if sampling_ratio:
            reader = reader.option("samplingRatio", sampling_ratio)
    if strict:
        reader = reader.option("enforceSchema", False)
    try:
        df = reader.csv(path)
        if not df.columns:
            raise FileNotFoundError(f"no CSV files found under {path!r}")
        return df
    except AnalysisException as e:
        condition = e.getCondition() if hasattr(e, "getCondition") else e.getErrorClass()
        if condition in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND") or "Unable to infer" in str(e):
            raise FileNotFoundError(f"no CSV files found under {path!r}") from e
        raise


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first line of each file, read up to its end alone."""
    for batch in batches:
        lines = []
        for path in batch["path"]:
            scheme, _, rest = path.partition(":")
            if scheme == "file":  # both file:/x and file:///x
                fs, inner = pafs.LocalFileSystem(), "/" + rest.lstrip("/")
            else:
                fs, inner = pafs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else path)
            with fs.open_input_stream(inner, compression="detect") as f:
                line = b""
                while b"\n" not in line and (more := f.read(1 << 12)):
                    line += more
            lines.append(line.split(b"\n", 1)[0].decode("utf-8-sig", "replace").rstrip("\r"))
        yield pd.DataFrame({"path": batch["path"], "header": lines})


def csv_by_header(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All CSV files under ``path`` (recursively) as one table of ``schema``, each
    file read under its own header.

    Columns are matched by name (as the file writes it, or sanitised as the
    loads do), so files may have them in any order; one that a file lacks is
    NULL, one that is not declared is left out.  The headers are read by
    tasks, one line a file; the files of one header are one scan, and nothing
    is inferred.  Header cells hold no line breaks.  Empty files have no rows.
    Raises ``FileNotFoundError`` when no CSV file exists under ``path``.
    """
    want = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        listed = (spark.read.format("text").option("recursiveFileLookup", True)
                  .option("pathGlobFilter", CSV_GLOB).load(path).inputFiles())
    except AnalysisException as e:
        raise FileNotFoundError(f"no CSV files found under {path!r}") from e
    if not listed:
        raise FileNotFoundError(f"no CSV files found under {path!r}")
    tasks = max(1, min(len(listed), 4 * spark.sparkContext.defaultParallelism))
    paths = spark.createDataFrame([(unquote(p),) for p in listed], "path string").repartition(tasks)
    by_header: dict[str, list[str]] = {}
    for r in paths.mapInPandas(_headers, "path string, header string").collect():  # names, one row a file
        by_header.setdefault(r.header, []).append(r.path)
    scans = []
    for header, files in sorted(by_header.items()):
        if not header:
            continue
        cells = next(csv.reader([header]))
        at = {}
        for i, cell in enumerate(cells):
            for name in (warehouse_identifier(cell), cell):
                at.setdefault(name, i)
        types = {at[f.name]: f.dataType for f in want.fields if f.name in at}
        # named as in the files where that gives distinct names, which spares a warning a file
        names = cells if len({c.lower() for c in cells} - {""}) == len(cells) else [f"c{i}" for i in range(len(cells))]
        raw = StructType([StructField(name, types.get(i, StringType())) for i, name in enumerate(names)])
        scan = (spark.read.schema(raw).option("header", True).option("enforceSchema", True).csv(sorted(files))
                .toDF(*[f"c{i}" for i in range(len(cells))]))
        scans.append(scan.select(*[(F.col(f"c{at[f.name]}") if f.name in at else F.lit(None)).cast(f.dataType).alias(f.name)
                                   for f in want.fields]))
    if not scans:
        return spark.createDataFrame([], want)
    return reduce(DataFrame.unionByName, scans)


def landed_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses: JSON-lines records ``{symbol, request_id, body}``
    where ``body`` is the raw response text."""
    return spark.read.schema(LANDED_RESPONSE_SCHEMA).json(path)


def message_files(spark: SparkSession, path: str) -> DataFrame:
    """A file stand-in for a keyed topic: JSON-lines ``{key, value}``."""
    return spark.read.schema(MESSAGE_FILE_SCHEMA).json(path)
