"""Embedding manifests and shard files. Ids: SRC-13..15."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annofold.operators.embeddings import rebased_path
from annofold.schemas import MANIFEST_COLUMNS, require_columns


def shard_list(spark: SparkSession, folder: str, pattern: str = "*.npy") -> DataFrame:
    """(shard_path) of the shard files in a folder, as a scan that reads no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.regexp_replace("path", "^file:/+", "/").alias("shard_path"))


def manifest_csv(spark: SparkSession, path: str, embeddings_root: str | None = None, existing: DataFrame | None = None) -> DataFrame:
    """A manifest file with its fixed columns, missing values as empty text.

    With ``embeddings_root``, paths of another machine are moved under it, but for those in
    ``existing`` (shard_path).
    """
    raw = spark.read.csv(path, header=True, inferSchema=False)
    require_columns(raw, MANIFEST_COLUMNS, "manifest")
    numbers = ("row_index", "row_index_in_batch", "sequence_length")
    out = raw.select(
        *(F.col(c).cast("int").alias(c) if c in numbers else F.coalesce(c, F.lit("")).alias(c) for c in MANIFEST_COLUMNS)
    )
    if embeddings_root is None:
        return out
    for column in ("batch_path", "shard_path"):
        if existing is None:
            out = out.withColumn(column, rebased_path(F.col(column), embeddings_root, F.lit(False)))
        else:
            there = existing.select(F.col("shard_path").alias("there")).distinct()
            joined = out.join(there, F.col(column) == F.col("there"), "left")
            out = joined.withColumn(column, rebased_path(F.col(column), embeddings_root, F.col("there").isNotNull())).drop("there")
    return out.select(*MANIFEST_COLUMNS)


def shard_vectors(spark: SparkSession, folder: str, pattern: str = "*.npy") -> DataFrame:
    """(shard_path, position, embedding) of all rows of the shard files in a folder.

    One task reads a shard at a time; a shard is as large as its batch.
    """

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in it:
            for path, content in zip(files["path"], files["content"], strict=True):
                x = np.load(io.BytesIO(content), allow_pickle=False).astype(np.float32)
                if x.ndim != 2:
                    raise ValueError(f"a shard must hold a matrix: {path}")
                yield pd.DataFrame({"shard_path": path, "position": np.arange(len(x), dtype=np.int32), "embedding": list(x)})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", "content")
    read = files.mapInPandas(run, "shard_path string, position int, embedding array<float>")
    return read.withColumn("shard_path", F.regexp_replace("shard_path", "^file:/+", "/"))
