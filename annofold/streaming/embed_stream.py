"""Embedding batches as a file stream. Ids: DOM-19, ML-10 (resumable extraction).

New batch files are picked up as they appear and become the shard files of the manifest. A
round of the stream writes its shards, each put in place at once, and then commits the manifest
with its batches complete as the version of that round. The stream's checkpoint knows which
rounds are done: a restart skips no batch and repeats at most the last round, which writes the same
shards over or, where its version is committed, nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from annofold import sinks
from annofold.operators.embeddings import (
    INFERENCE_BATCH_SIZE,
    MAX_SEQUENCE_LENGTH,
    Encoder,
    complete_batches,
    extract_embeddings,
)
from annofold.streaming.manifest_log import commit_manifest, read_manifest, versions

BATCH_DDL = "entry_id string, sequence string, sequence_length int, row_index long, row_index_in_batch int, batch_id string"


def start_embedding_stream(
    spark: SparkSession,
    batches_path: str,
    shards_root: str,
    checkpoint_path: str,
    load_encoder: Callable[[], Encoder],
    inference_batch_size: int = INFERENCE_BATCH_SIZE,
    max_length: int | None = MAX_SEQUENCE_LENGTH,
    manifest_path: str | None = None,
    completed_at: str = "",
    files_per_round: int | None = None,
) -> StreamingQuery:
    """Encode all batch files that are there and not yet done to ``shards_root``, then stop.

    ``manifest_path`` is a manifest log (``manifest_log``) that holds the manifest of the
    batches; each round commits it with its own batches complete. ``files_per_round`` bounds
    the batches of a round.

    ``batches_path`` as written by ``annofold.sinks.write_batches``: a batch is one file, so it
    is never cut between two rounds of the stream.
    """
    reader = spark.readStream.schema(BATCH_DDL)
    if files_per_round:
        reader = reader.option("maxFilesPerTrigger", files_per_round)
    batches = reader.parquet(batches_path)

    def encode(some: DataFrame, number: int) -> None:
        version = number + 1  # version 0 is the manifest before any round
        if manifest_path is not None and version in versions(spark, manifest_path):
            return
        written = sinks.write_shards(extract_embeddings(some, load_encoder, None, inference_batch_size, max_length), shards_root)
        if manifest_path is not None:
            commit_manifest(complete_batches(read_manifest(spark, manifest_path), written, completed_at), manifest_path, version)

    return (
        batches.writeStream.foreachBatch(encode)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
