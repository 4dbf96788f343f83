"""Embedding manifests, batches, and resumable extraction with a pluggable encoder.

Ids: PRJ-17, DOM-18..20, WIN-06, AGG-17, SNK-06, ML-07..10, SRC-14 (paths).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annofold.operators.ranks import with_row_index
from annofold.schemas import MANIFEST_COLUMNS, fail_if_any, require_columns

MODEL_NAME = "esm2_t33_650M_UR50D"
BATCH_SIZE = 512
INFERENCE_BATCH_SIZE = 8
MAX_SEQUENCE_LENGTH = 1022

#: A list of sequences in, one vector of equal length for each out.
Encoder = Callable[[list[str]], np.ndarray]


@dataclass(frozen=True)
class BatchConfig:
    """How a table of sequences is cut into batches and where these go."""

    split: str
    output_dir: str
    batch_size: int = BATCH_SIZE
    model_name: str = MODEL_NAME

    def as_dict(self) -> dict[str, object]:
        """Plain values, for a report."""
        return asdict(self)


def normalize_sequences(sequences: DataFrame) -> DataFrame:
    """(entry_id, sequence, sequence_length, row_index): one row per entry, in order of entry_id.

    Of repeated entries the first by ``sequence_index`` stays, or where that column is absent
    the smallest sequence. Rows without an id or a sequence go.
    """
    require_columns(sequences, ("entry_id", "sequence"), "sequences")
    at = F.col("sequence_index").cast("long") if "sequence_index" in sequences.columns else F.lit(0).cast("long")
    first = (
        sequences.select(
            F.col("entry_id").cast("string").alias("entry_id"), F.col("sequence").cast("string").alias("sequence"), at.alias("at")
        )
        .na.drop(subset=["entry_id", "sequence"])
        .groupBy("entry_id")
        .agg(F.min(F.struct("at", "sequence")).alias("first"))
        .select("entry_id", F.col("first.sequence").alias("sequence"))
        .withColumn("sequence_length", F.length("sequence"))
    )
    return with_row_index(first, ["entry_id"])


def _numbered(stem: str, row_index: Column, batch_size: int, ending: str = "") -> Column:
    return F.concat(F.lit(stem), F.lpad(F.floor(row_index / batch_size).cast("string"), 5, "0"), F.lit(ending))


def batches_of(normalized: DataFrame, config: BatchConfig) -> DataFrame:
    """``normalized`` sequences with batch_id and row_index_in_batch."""
    if config.batch_size <= 0:
        raise ValueError("the batch size must be positive")
    return normalized.withColumn("batch_id", _numbered("batch_", F.col("row_index"), config.batch_size)).withColumn(
        "row_index_in_batch", F.pmod(F.col("row_index"), F.lit(config.batch_size)).cast("int")
    )


def create_manifest(normalized: DataFrame, config: BatchConfig) -> DataFrame:
    """One row per sequence with its batch, its place in it, and the paths of batch and shard."""
    root = str(config.output_dir).rstrip("/")
    return batches_of(normalized, config).select(
        "entry_id",
        F.lit(config.split).alias("split"),
        "batch_id",
        F.col("row_index").cast("int").alias("row_index"),
        "row_index_in_batch",
        F.col("sequence_length").cast("int").alias("sequence_length"),
        F.concat(F.lit(f"{root}/batches/"), F.col("batch_id"), F.lit(".parquet")).alias("batch_path"),
        _numbered(f"{root}/shard_", F.col("row_index"), config.batch_size, ".npy").alias("shard_path"),
        F.lit(config.model_name).alias("model_name"),
        F.lit("pending").alias("status"),
        F.lit("").alias("completed_at"),
    )


def with_shard_status(manifest: DataFrame, shards: DataFrame) -> DataFrame:
    """Rows whose shard_path is in ``shards`` (shard_path) become ``complete``."""
    there = shards.select(F.col("shard_path").alias("there")).distinct()
    marked = manifest.join(there, F.col("shard_path") == F.col("there"), "left")
    status = F.when(F.col("there").isNotNull(), F.lit("complete")).otherwise(F.col("status"))
    return marked.withColumn("status", status).select(*manifest.columns)


def pending_batches(manifest: DataFrame) -> DataFrame:
    """(batch_id) of batches that are not complete."""
    return manifest.filter("status IS NULL OR status != 'complete'").select("batch_id").distinct()


def mark_complete(manifest: DataFrame, batch_id: str, completed_at: str, validate: bool = True) -> DataFrame:
    """The manifest with one batch complete; ``validate`` fails at once on an unknown batch."""
    mine = F.col("batch_id") == batch_id
    if validate and manifest.filter(mine).isEmpty():
        raise ValueError(f"unknown batch: {batch_id}")
    return manifest.withColumn("status", F.when(mine, F.lit("complete")).otherwise(F.col("status"))).withColumn(
        "completed_at", F.when(mine, F.lit(completed_at)).otherwise(F.col("completed_at"))
    )


def complete_batches(manifest: DataFrame, done: DataFrame, completed_at: str) -> DataFrame:
    """The manifest with all batches of ``done`` (batch_id) complete."""
    there = done.select(F.col("batch_id").alias("there")).distinct()
    marked = manifest.join(there, F.col("batch_id") == F.col("there"), "left")
    new = F.col("there").isNotNull()
    return marked.select(
        *(
            F.when(new, F.lit({"status": "complete", "completed_at": completed_at}[c])).otherwise(F.col(c)).alias(c)
            if c in ("status", "completed_at")
            else F.col(c)
            for c in manifest.columns
        )
    )


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """One row: n_sequences, n_batches, n_complete, n_pending, splits, models, n_pending_batches."""
    done = F.col("status") == "complete"
    return manifest.agg(
        F.count(F.lit(1)).alias("n_sequences"),
        F.count_distinct("batch_id").alias("n_batches"),
        F.count_if(done).alias("n_complete"),
        F.count_if(~done).alias("n_pending"),
        F.array_sort(F.collect_set("split")).alias("splits"),
        F.array_sort(F.collect_set("model_name")).alias("models"),
        F.count_distinct(F.when(~done, F.col("batch_id"))).alias("n_pending_batches"),
    )


def rebased_path(column: Column, embeddings_root: str, exists: Column) -> Column:
    """A path from another machine moved under ``embeddings_root``, unless it exists here.

    Whatever follows ``/artifacts/embeddings/`` (with either slash) is kept.
    """
    plain = F.replace(column, F.lit("\\"), F.lit("/"))
    marker = "/artifacts/embeddings/"
    after = F.substring(plain, F.locate(marker, plain) + len(marker), F.length(plain))
    moved = F.concat(F.lit(embeddings_root.rstrip("/") + "/"), after)
    return F.when((column == "") | exists | (F.locate(marker, plain) == 0), column).otherwise(moved)


def mean_pool(tokens: Column) -> Column:
    """Mean of the token vectors of a sequence without its first and last one (array<array<double>>)."""
    inner = F.slice(tokens, 2, F.greatest(F.size(tokens) - 2, F.lit(0)))
    width = F.size(F.get(tokens, F.lit(0)))
    summed = F.aggregate(
        inner,
        F.transform(F.sequence(F.lit(1), width), lambda _: F.lit(0.0)),
        lambda total, v: F.zip_with(total, v, lambda a, b: a + b),
    )
    return F.when(F.size(inner) > 0, F.transform(summed, lambda x: x / F.size(inner)))


def extract_embeddings(
    batches: DataFrame,
    load_encoder: Callable[[], Encoder],
    done: DataFrame | None = None,
    inference_batch_size: int = INFERENCE_BATCH_SIZE,
    max_length: int | None = MAX_SEQUENCE_LENGTH,
) -> DataFrame:
    """(entry_id, batch_id, row_index, row_index_in_batch, embedding) of batches not in ``done`` (batch_id).

    The encoder is loaded once per task. ``max_length`` is the model's own limit of residues.
    Restarting with the batches already written as ``done`` goes on where a run stopped.
    """
    todo = batches if done is None else batches.join(done.select("batch_id").distinct(), "batch_id", "left_anti")
    keys = ("entry_id", "batch_id", "row_index", "row_index_in_batch")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = None
        for rows in it:
            encoder = encoder or load_encoder()
            parts = []
            for at in range(0, len(rows), inference_batch_size):
                some = rows["sequence"].iloc[at : at + inference_batch_size]
                parts.append(np.asarray(encoder([s[:max_length] for s in some]), np.float32))
            if parts:
                yield rows[list(keys)].assign(embedding=list(np.concatenate(parts)))

    ddl = "entry_id string, batch_id string, row_index long, row_index_in_batch int, embedding array<float>"
    return todo.select(*keys, "sequence").mapInPandas(run, ddl)


def check_manifest(manifest: DataFrame) -> None:
    """Fail on missing columns, an empty manifest or a batch that is not complete."""
    require_columns(manifest, MANIFEST_COLUMNS, "manifest")
    if manifest.isEmpty():
        raise ValueError("the manifest is empty")
    fail_if_any(pending_batches(manifest), "batches without embeddings", "batch_id")
