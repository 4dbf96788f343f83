"""The embedding stream: atomic versions of the manifest, failures and restarts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException

from annofold import sinks, sources
from annofold.operators import embeddings as e
from annofold.streaming import embed_stream, manifest_log
from annofold.streaming.embed_stream import start_embedding_stream


@pytest.fixture()
def prepared(spark, tmp_path):
    sequences = spark.createDataFrame([(f"P{k:02d}", "M" * (k + 1), k) for k in range(10)], "entry_id string, sequence string, row_index long")
    sequences = e.normalize_sequences(sequences.drop("row_index"))
    root = str(tmp_path)
    manifest = e.create_manifest(sequences, e.BatchConfig("train", root, 3))
    sinks.write_batches(manifest.join(sequences.select("entry_id", "sequence"), "entry_id"), f"{root}/train/batches")
    manifest_log.commit_manifest(manifest, f"{root}/log", 0)
    return root


def start(spark, root, load, files=1):
    return start_embedding_stream(spark, f"{root}/train/batches", f"{root}/train", f"{root}/checkpoint", load, manifest_path=f"{root}/log", completed_at="then", files_per_round=files)


@pytest.fixture()
def lengths():
    return lambda: lambda some: [[float(len(s))] for s in some]


def outcome(spark, root):
    done = manifest_log.read_manifest(spark, f"{root}/log")
    shards = sorted((r["shard_path"].rsplit("/", 1)[1], r["position"], r["embedding"][0]) for r in sources.shard_vectors(spark, f"{root}/train").collect())
    return {r["batch_id"]: r["status"] for r in done.collect()}, shards


WHOLE = (
    {f"batch_0000{k}": "complete" for k in range(4)},
    [(f"shard_0000{k // 3}.npy", k % 3, float(k + 1)) for k in range(10)],
)


def test_versions(spark, prepared):
    log = f"{prepared}/log"
    first = manifest_log.read_manifest(spark, log)
    assert not manifest_log.commit_manifest(first.limit(0), log, 0) and manifest_log.read_manifest(spark, log).count() == 10
    # What a writer left that was killed before its rename is not read.
    first.limit(1).write.parquet(f"{log}/_writing-killed")
    assert manifest_log.versions(spark, log) == [0] and manifest_log.read_manifest(spark, log).count() == 10
    assert manifest_log.commit_manifest(first.limit(4), log, 3) and manifest_log.read_manifest(spark, log).count() == 4
    with pytest.raises(ValueError, match="no manifest"):
        manifest_log.read_manifest(spark, f"{prepared}/elsewhere")


def test_a_failure_inside_a_batch(spark, prepared, lengths):
    def failing():
        def encode(some):
            if any(len(s) == 5 for s in some):
                raise RuntimeError("lost")
            return [[float(len(s))] for s in some]

        return encode

    with pytest.raises(StreamingQueryException):
        start(spark, prepared, failing).awaitTermination()
    done, shards = outcome(spark, prepared)
    finished = [b for b, s in done.items() if s == "complete"]
    # Rounds before the failure are committed with their shards, the failed one is not.
    assert sorted(finished) == sorted({f"batch_{s[6:11]}" for s, _, _ in shards}) and "batch_00001" not in finished
    start(spark, prepared, lengths).awaitTermination()
    assert outcome(spark, prepared) == WHOLE
    assert manifest_log.versions(spark, f"{prepared}/log") == [0, 1, 2, 3, 4]
    start(spark, prepared, lengths).awaitTermination()
    assert manifest_log.versions(spark, f"{prepared}/log") == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("after", [False, True])
def test_a_failure_around_the_commit(spark, prepared, lengths, monkeypatch, after):
    commit, calls = manifest_log.commit_manifest, []

    def lost(manifest, path, version):
        calls.append(version)
        if version == 2 and calls.count(2) == 1:
            if after:
                commit(manifest, path, version)
            raise RuntimeError("lost")
        return commit(manifest, path, version)

    encoded = []
    extract = embed_stream.extract_embeddings
    monkeypatch.setattr(embed_stream, "commit_manifest", lost)
    monkeypatch.setattr(embed_stream, "extract_embeddings", lambda some, *a: (encoded.append(some.select("batch_id").distinct().count()), extract(some, *a))[1])
    with pytest.raises(StreamingQueryException):
        start(spark, prepared, lengths).awaitTermination()
    start(spark, prepared, lengths).awaitTermination()
    assert outcome(spark, prepared) == WHOLE
    # A round whose version was committed is not encoded again.
    assert sum(encoded) == (4 if after else 5)


def test_shards_read_back_as_written(spark, prepared, lengths):
    start(spark, prepared, lengths, None).awaitTermination()
    assert outcome(spark, prepared) == WHOLE
    assert np.load(f"{prepared}/train/shard_00003.npy").tolist() == [[10.0]]
