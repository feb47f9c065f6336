"""Reading the corpus tables, and the shared folder for tables between jobs."""

from __future__ import annotations

import ctypes
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of a few longs in a file of a cut table whose size is known.
ROWS_A_FILE = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table by the path that the session's readers understand, with the named columns only."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Writes df into the cluster's checkpoint folder and goes on from there.

    The folder is the one in spark.checkpoint.dir. Only where that is unset and
    Spark runs on this machine alone, as in tests, a temporary folder is taken.
    rows: an upper bound of the rows where it is known (a count, say); then no
    more files are written than one for each ROWS_A_FILE of them, or one for each
    core of the cluster. Every file costs the executor a fork of itself.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="kinweave-")
        sc.setCheckpointDir(folder)
    if rows is not None:
        df = df.coalesce(max(sc.defaultParallelism, -(-rows // ROWS_A_FILE)))
    return df.checkpoint()


def modest_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Sends texts to Python in batches of at most so many rows, unless the session asks for fewer.

    Spark counts 10,000 rows whatever their size; of long texts that is tens of
    megabytes, held by the executor and by each of its workers.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def release() -> None:
    """Gives memory that a Python worker no longer uses back to the system, at the end of a task: workers are used again."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def settle(spark: SparkSession) -> None:
    """Has the executors collect garbage, after which their JVMs give heap that isn't used back to the system.

    Between the jobs of a long run, whose shuffles leave heaps at their largest; takes
    about half a second. On one machine there is one JVM, which is asked directly.
    """
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local":
        spark._jvm.java.lang.System.gc()
        return
    n = 2 * sc._jsc.sc().getExecutorMemoryStatus().size()
    spark.range(0, n, 1, n).select(F.expr("reflect('java.lang.System', 'gc')")).collect()
