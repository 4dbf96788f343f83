"""Writers of tables and reports. Ids: SNK-01..09."""

from __future__ import annotations

import io
import json
import os
import re
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pa_fs
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annofold.schemas import MANIFEST_COLUMNS, SUBMISSION_COLUMNS, require_columns
from annofold.storage import settled

#: Bytes that are copied at once.
COPIED = 8 << 20


def write_parquet(df: DataFrame, path: str) -> str:
    """Replace the table at ``path``."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_parquet_counted(df: DataFrame, path: str, name: str = "written") -> int:
    """Replace the table at ``path`` and return its number of rows, counted while writing."""
    from pyspark.sql import Observation

    seen = Observation(name)
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return int(seen.get["n"])


def write_json(data: dict, path: str) -> str:
    """A report with sorted keys and an indent of two, in any store that Arrow knows."""
    _write_bytes(path, (json.dumps(data, indent=2, sort_keys=True, default=str) + "\n").encode())
    return path


def score_text(score: Column) -> Column:
    """A score in all its digits, without trailing zeros, so that reading it gives the same double.

    Plain digits up to 36 places; a number too small or too large for them has an exponent.
    """
    told = score.cast("double").cast("string")
    plain = told.try_cast("decimal(38,36)")
    digits = F.regexp_replace(F.regexp_replace(plain.cast("string"), "0+$", ""), r"\.$", ".0")
    return F.when(plain.isNotNull() & (plain.cast("double") == score.cast("double")), digits).otherwise(told)


def write_submission(df: DataFrame, path: str) -> str:
    """Tab-separated entry, term and score without a header, as part files in a folder."""
    require_columns(df, SUBMISSION_COLUMNS, "submission")
    rows = df.select("entry_id", "term", score_text(F.col("score")).alias("score"))
    rows.write.mode("overwrite").csv(path, sep="\t", header=False, quote="")
    return path


def write_text_file(lines: DataFrame, path: str, order: Sequence[str | Column]) -> str:
    """``lines`` (value, and the columns of ``order``) as one text file in order, which takes the place of ``path``.

    Rows are sorted by ranges and written as parts in parallel; the parts are then joined in
    order. A store that can join files does it without moving data; for any other one a task
    copies the parts one after another, some bytes at a time. The file is put in place by a
    rename, so readers see all of it or none.
    """
    spark = lines.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hidden = f"{path.rstrip('/')}.writing-{uuid.uuid4().hex}"
    lines.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("value").write.text(hidden)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    folder, goal = jvm_path(hidden), jvm_path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.globStatus(jvm_path(f"{hidden}/part-*"))
    names = sorted(str(f.getPath().toString()) for f in found if f.getLen())
    whole = _concatenated(spark, store, names) or _copied_together(spark, names, f"{hidden}/whole.txt")
    store.delete(goal, True)
    if not store.rename(jvm_path(whole), goal):
        raise OSError(f"cannot write {path}")
    store.delete(folder, True)
    return path


def _concatenated(spark: SparkSession, store, names: list[str]) -> str | None:
    """The first file with all others appended by the store itself; None where it cannot."""
    if not names:
        return None
    rest = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(names) - 1)
    for k, name in enumerate(names[1:]):
        rest[k] = spark._jvm.org.apache.hadoop.fs.Path(name)
    if len(names) > 1:
        try:
            store.concat(spark._jvm.org.apache.hadoop.fs.Path(names[0]), rest)
        except UnsupportedOperationException:
            return None
    return names[0]


def _copied_together(spark: SparkSession, names: list[str], path: str) -> str:
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in it:
            store, inner = arrow_store(path)
            with store.open_output_stream(inner, compression=None) as out:
                for name in frame["name"].iloc[0]:
                    part_store, part = arrow_store(name)
                    with part_store.open_input_stream(part, compression=None) as source:
                        while chunk := source.read(COPIED):
                            out.write(chunk)
            yield pd.DataFrame({"done": [len(frame)]})

    spark.createDataFrame([(names,)], "name array<string>").coalesce(1).mapInPandas(run, "done long").collect()
    return path


def write_submission_file(df: DataFrame, path: str) -> str:
    """Tab-separated entry, term and score without a header, one file: by entry, best score first, then term."""
    require_columns(df, SUBMISSION_COLUMNS, "submission")
    line = F.concat_ws("\t", "entry_id", "term", score_text(F.col("score")))
    return write_text_file(df.select(line.alias("value"), *SUBMISSION_COLUMNS), path, ["entry_id", F.desc("score"), "term"])


def write_manifest(df: DataFrame, path: str) -> str:
    """A manifest as CSV with a header and the fixed columns."""
    require_columns(df, MANIFEST_COLUMNS, "manifest")
    df.select(*MANIFEST_COLUMNS).write.mode("overwrite").csv(path, header=True, emptyValue="", nullValue="")
    return path


def write_batches(batches: DataFrame, path: str, append: bool = False) -> str:
    """Batches as the files ``batch_id``.parquet in one folder, the paths that a manifest names.

    The tasks write the files, each put in place at once, so the driver does nothing for a single
    file. A task holds one batch at a time; one that is run again writes the same files again.
    ``append`` keeps the batches that are there.
    """
    spark = batches.sparkSession
    columns = ("entry_id", "sequence", "sequence_length", "row_index", "batch_id", "row_index_in_batch")
    root = path.rstrip("/")
    if not append:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    def save(parts: list[pa.RecordBatch]) -> None:
        buffer = io.BytesIO()
        pq.write_table(pa.Table.from_batches(parts), buffer)
        _write_bytes(f"{root}/{parts[0].column('batch_id')[0].as_py()}.parquet", buffer.getvalue())

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        done = 0
        for rows in it:
            if not rows.num_rows:
                continue
            ids = rows.column("batch_id")
            new = np.flatnonzero(pc.not_equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)) + 1
            for at, end in zip([0, *new], [*new, rows.num_rows], strict=True):
                if held and held[0].column("batch_id")[0] != ids[int(at)]:
                    save(held)
                    held, done = [], done + 1
                held.append(rows.slice(int(at), int(end - at)))
        if held:
            save(held)
            done += 1
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["written"])

    placed = batches.select(*columns).repartition("batch_id").sortWithinPartitions("batch_id", "row_index")
    placed.mapInArrow(run, "written long").agg(F.sum("written")).collect()
    return path


def arrow_store(path: str) -> tuple[pa_fs.FileSystem, str]:
    """The store of ``path`` that Arrow knows, and the path inside it."""
    path = re.sub("^file:/+", "/", path)
    if "://" in path:
        return pa_fs.FileSystem.from_uri(quote(path, safe=":/%?=&@"))
    return pa_fs.LocalFileSystem(), os.path.abspath(path)


def _write_bytes(path: str, content: bytes) -> None:
    """Put a whole file in place at once, in any store that Arrow knows."""
    store, inner = arrow_store(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    # A hidden name: a stream may read the folder meanwhile.
    folder, name = inner.rsplit("/", 1)
    part = f"{folder}/_{name}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as out:
        out.write(content)
    store.move(part, inner)


def write_shards(vectors: DataFrame, root: str) -> DataFrame:
    """Write ``vectors`` (batch_id, row_index_in_batch, embedding) as ``.npy`` files, one matrix a batch.

    The files are those that a manifest with ``root`` names: batch_00000 is shard_00000.npy.
    Rows come in order of row_index_in_batch. Returns (batch_id, shard_path, n_rows) of the
    files written. A task holds one batch at a time; a task that is run again writes the same
    files again.
    """
    root = root.rstrip("/")

    def save(batch: str, rows: list[np.ndarray]) -> tuple[str, str, int]:
        buffer = io.BytesIO()
        np.save(buffer, np.stack(rows).astype(np.float32))
        path = f"{root}/shard_{batch.removeprefix('batch_')}.npy"
        _write_bytes(path, buffer.getvalue())
        return batch, path, len(rows)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        last = None
        done = []
        for frame in it:
            for batch, vector in zip(frame["batch_id"], frame["embedding"], strict=True):
                if held and batch != last:
                    done.append(save(last, held))
                    held = []
                last = batch
                held.append(np.asarray(vector))
        if held:
            done.append(save(last, held))
        yield pd.DataFrame(done, columns=["batch_id", "shard_path", "n_rows"])

    placed = vectors.select("batch_id", "row_index_in_batch", "embedding").repartition("batch_id")
    placed = placed.sortWithinPartitions("batch_id", "row_index_in_batch")
    return settled(placed.mapInPandas(run, "batch_id string, shard_path string, n_rows int"))


def write_csv(df: DataFrame, path: str) -> str:
    """A small report as CSV with a header."""
    df.write.mode("overwrite").csv(path, header=True)
    return path
