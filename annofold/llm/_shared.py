"""Helpers that several operators share: durable intermediates, dense ranks, byte batches."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a batch that a Python stage handles at once.
SLICE = 2000

#: Rows of numbers (about 50 bytes each) up to which a side is broadcast.
BROADCAST_ROWS = 500_000

_own_folder: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which every executor can reach.

    Only a session on one machine may lack that setting, as in tests: a temporary folder is
    made for it. On a cluster executors could not see one another's files, so it fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if app not in _own_folder:
            _own_folder[app] = tempfile.mkdtemp(prefix="spark-")
        root = _own_folder[app]
    path = f"{root.rstrip('/')}/annofold-{uuid.uuid4().hex}"
    _written.setdefault(app, []).append(path)
    return path


def drop_intermediates(spark: SparkSession) -> int:
    """Delete what ``durable`` wrote in this session; returns the number of folders.

    For the end of a job: DataFrames that rest on these tables cannot be read afterwards.
    """
    paths = _written.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    return len(paths)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a scan of it.

    Cuts the lineage so that a lost executor costs a reread, not a recomputation, and
    so that later actions see the same rows.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(keys: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``keys``, settled, with a broadcast hint if it has at most ``bound`` rows.

    For a narrow side joined to texts: up to the bound the texts stay where they are, beyond
    it both sides are shuffled, with the same rows. ``keys`` holds a few numbers per row.
    """
    held = durable(keys)
    return F.broadcast(held) if held.count() <= bound else held


def row_mark() -> Column:
    """A number of its own for each row; only for tables that are written at once."""
    return F.monotonically_increasing_id()


def dense_rank_in(
    df: DataFrame, keys: Sequence[str], spread: Sequence[str], total: int, name: str
) -> DataFrame:
    """Add ``name``: 0-based gapless position of each row within its ``keys``.

    A key may hold any share of the rows: each is cut by a hash of ``spread`` into as
    many parts as keep a part near 100,000 rows, ranks are taken inside a part, and the
    (small) counts of the parts are summed to offsets. ``df`` must be repeatable, and
    ``spread`` must tell rows apart, or equal ones would meet in one part: a table without
    such columns gets ``row_mark`` before it is written.
    """
    parts = max(16, -(-total // 100_000))
    salted = df.withColumn("__part", F.pmod(F.xxhash64(*spread), F.lit(parts)))
    part = Window.partitionBy(*keys, "__part")
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        salted.groupBy(*keys, "__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    ranked = salted.withColumn("__at", F.row_number().over(part.orderBy(*spread)) - 1)
    return (
        ranked.join(offsets, [*keys, "__part"])
        .withColumn(name, (F.col("__at") + F.col("__offset")).cast("long"))
        .drop("__part", "__at", "__offset")
    )


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int = SLICE) -> Callable:
    """``run`` over slices of its batches of at most ``rows`` rows; freed memory goes back to the system at the end.

    Python workers serve one stage after another, so what a stage leaves in their allocators
    would add to the next one's memory.
    """

    def over(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (batch.slice(at, rows) for batch in it for at in range(0, batch.num_rows, rows))
        try:
            yield from run(slices)
        finally:
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                ctypes.CDLL(None).malloc_trim(0)

    return over


def utf8_column(batch: pa.RecordBatch, at: int) -> list[bytes | None]:
    """A string column of an Arrow batch as UTF-8 bytes, None where null."""
    return batch.column(at).cast(pa.binary()).to_pylist()


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Pack an iterator of tuples into Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)],
        schema=schema,
    )
