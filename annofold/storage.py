"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows (of about 100 bytes) up to which a side of a join is broadcast.
BROADCAST_ROWS = 1_000_000
#: Rows that a task takes where rows are dealt by a key.
TASK_ROWS = 100_000

_own: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession) -> str:
    """A fresh path under ``spark.checkpoint.dir``.

    A temporary folder where that is unset, but only in a session on one machine: on a cluster
    executors could not see one another's files, so it fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="spark-")
        root = _own[app]
    path = f"{root.rstrip('/')}/step-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_intermediates(spark: SparkSession) -> int:
    """Delete the session's intermediate tables, at the end of a job; returns their number."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(paths)


def settled(df: DataFrame, *by: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: short lineage that survives a lost executor.

    In one folder for each value of the columns ``by``, which then come last: filters on them
    choose the folders that are read.
    """
    path = scratch_path(df.sparkSession)
    if by:
        df = df.select(*(c for c in df.columns if c not in by), *by)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled_with(df: DataFrame, *told: Column) -> tuple[DataFrame, dict]:
    """``settled``, and named aggregates of the rows, taken while they are written."""
    seen = Observation()
    out = settled(df.observe(seen, *told))
    return out, seen.get


def broadcast_if_small(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, settled, with a broadcast hint if it has at most ``bound`` rows; beyond that joins shuffle both sides."""
    held, seen = settled_with(df, F.count(F.lit(1)).alias("n"))
    return F.broadcast(held) if seen["n"] <= bound else held


def dealt(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by the columns ``by`` to tasks of about ``TASK_ROWS`` each.

    A stated number of tasks, which AQE does not merge: it merges by the bytes of a shuffle, and joins
    and hash tables behind it may need a hundred times as many. Aggregations, windows and broadcast
    joins by keys that hold ``by`` follow without another shuffle.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.repartition(tasks, *by)
