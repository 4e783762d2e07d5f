"""Tables in the shared folder: written once, read many times, safe to lose executors."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import fresh_dir


def spill(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and reread it.

    Cuts the lineage and gives the optimiser true sizes; nothing is cached on
    an executor, so a lost one costs only its running tasks.
    """
    path = f"{fresh_dir(df.sparkSession, label)}/table"
    df.write.option("compression", codec).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.spilled_to = path
    return table


def drop(*tables: DataFrame) -> None:
    """Delete spilled tables that nothing will read any more; other frames are left alone."""
    for t in tables:
        if getattr(t, "spilled_to", None):
            path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.spilled_to)
            path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def settle(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs.

    Its cleaner acts once the driver has collected the jobs' plans, by itself
    after half an hour (spark.cleaner.periodicGC.interval); an operator of many
    steps would hold all their shuffles on disk until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table of the driver's folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch.  Rows alone bound nothing: 10,000 long texts are a batch held by the JVM and by the worker.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once a session, and batches of bounded bytes.

    The batch bound is set only where the session has none.  The package is
    not needed where they inherit a PYTHONPATH or ``--py-files`` with it; in a
    session that only the driver's ``sys.path`` knows about, it is.
    """
    if spark.conf.get(_BATCH_KEY, None) is None:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if getattr(sc, "_ledgerline_shipped", False) or top in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-"), "ledgerline-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "ledgerline")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), top))
    sc.addPyFile(path)
    sc._ledgerline_shipped = True
