from __future__ import annotations

import numpy as np
import pytest

from annofold import sinks, sources
from annofold.operators import embeddings as e
from annofold.operators import features as f
from annofold.operators import models as ml
from annofold.streaming import start_embedding_stream


def sequences(spark):
    return spark.createDataFrame(
        [("c", "MMM", 0), ("a", "M", 1), ("b", "MM", 2), ("a", "LATER", 3), (None, "M", 4)], "entry_id string, sequence string, sequence_index long"
    )


def manifest(spark, root="art"):
    return e.create_manifest(e.normalize_sequences(sequences(spark)), e.BatchConfig("train", root, 2))


def test_manifest(spark):
    got = [tuple(r)[:8] for r in manifest(spark).orderBy("row_index").collect()]
    assert got == [
        ("a", "train", "batch_00000", 0, 0, 1, "art/batches/batch_00000.parquet", "art/shard_00000.npy"),
        ("b", "train", "batch_00000", 1, 1, 2, "art/batches/batch_00000.parquet", "art/shard_00000.npy"),
        ("c", "train", "batch_00001", 2, 0, 3, "art/batches/batch_00001.parquet", "art/shard_00001.npy"),
    ]
    with pytest.raises(ValueError, match="positive"):
        e.create_manifest(e.normalize_sequences(sequences(spark)), e.BatchConfig("train", "art", 0))
    assert e.BatchConfig("train", "art").as_dict()["batch_size"] == 512


def test_status(spark, rows):
    m = manifest(spark)
    done = spark.createDataFrame([("art/shard_00000.npy",)], "shard_path string")
    marked = e.with_shard_status(m, done)
    assert rows(e.pending_batches(marked)) == [("batch_00001",)]
    summary = e.manifest_summary(marked).first().asDict()
    assert (summary["n_sequences"], summary["n_batches"], summary["n_complete"], summary["splits"]) == (3, 2, 2, ["train"])
    finished = e.mark_complete(marked, "batch_00001", "2020-01-01T00:00:00+00:00")
    assert e.pending_batches(finished).count() == 0
    with pytest.raises(ValueError, match="unknown batch"):
        e.mark_complete(m, "batch_9", "now")
    with pytest.raises(ValueError, match="batch_00001"):
        e.check_manifest(marked)


def test_manifest_file(spark, tmp_path, rows):
    path = sinks.write_manifest(manifest(spark, "/old/artifacts/embeddings/train"), str(tmp_path / "m"))
    read = sources.manifest_csv(spark, path, "/new/embeddings")
    assert rows(read, "shard_path")[0] == ("/new/embeddings/train/shard_00000.npy",)
    assert read.first()["completed_at"] == ""
    win = spark.createDataFrame([("C:\\x\\artifacts\\embeddings\\t\\s.npy",)], "p string")
    from pyspark.sql import functions as F

    assert win.select(e.rebased_path(F.col("p"), "/n", F.lit(False))).first()[0] == "/n/t/s.npy"
    assert win.select(e.rebased_path(F.col("p"), "/n", F.lit(True))).first()[0].startswith("C:")


def _loader():
    """A nested function, which workers get by value: they cannot import this file."""

    def load():
        return lambda texts: np.array([[len(t), t.count("M")] for t in texts], np.float32)

    return load


load_encoder = _loader()


def test_extraction_resumes(spark, tmp_path):
    batches = e.batches_of(e.normalize_sequences(sequences(spark)), e.BatchConfig("train", "art", 2))
    got = {r["entry_id"]: list(r["embedding"]) for r in e.extract_embeddings(batches, load_encoder, max_length=2).collect()}
    assert got == {"a": [1, 1], "b": [2, 2], "c": [2, 2]}
    done = spark.createDataFrame([("batch_00000",)], "batch_id string")
    assert [r["entry_id"] for r in e.extract_embeddings(batches, load_encoder, done).collect()] == ["c"]


def test_stream_encodes_each_batch_once(spark, tmp_path):
    places = [str(tmp_path / k) for k in ("in", "out", "checkpoint")]
    batches = e.batches_of(e.normalize_sequences(sequences(spark)), e.BatchConfig("train", "art", 2))
    sinks.write_batches(batches.filter("batch_id = 'batch_00000'"), places[0])
    start_embedding_stream(spark, *places, load_encoder).awaitTermination()
    assert sources.shard_vectors(spark, places[1]).count() == 2
    first = (tmp_path / "out" / "shard_00000.npy").stat().st_mtime_ns
    sinks.write_batches(batches.filter("batch_id = 'batch_00001'"), places[0], append=True)
    start_embedding_stream(spark, *places, load_encoder).awaitTermination()
    assert (tmp_path / "out" / "shard_00000.npy").stat().st_mtime_ns == first
    # The shards are those that the manifest names, so they assemble.
    m = e.create_manifest(e.normalize_sequences(sequences(spark)), e.BatchConfig("train", places[1], 2))
    m = e.with_shard_status(m, sources.shard_list(spark, places[1]))
    whole = f.assemble_embeddings(m, sources.shard_vectors(spark, places[1])).orderBy("row_index").collect()
    assert [(r["entry_id"], list(r["embedding"])) for r in whole] == [("a", [1, 1]), ("b", [2, 2]), ("c", [3, 3])]


def test_batch_files_are_where_the_manifest_says(spark, tmp_path, rows):
    config = e.BatchConfig("train", str(tmp_path), 2)
    normalized = e.normalize_sequences(sequences(spark))
    sinks.write_batches(e.batches_of(normalized, config), str(tmp_path / "batches"))
    for r in e.create_manifest(normalized, config).select("batch_id", "batch_path").distinct().collect():
        batch = spark.read.parquet(r["batch_path"])
        assert {x["batch_id"] for x in batch.collect()} == {r["batch_id"]}
    assert rows(spark.read.parquet(str(tmp_path / "batches")), "entry_id") == [("a",), ("b",), ("c",)]


def test_mean_pool(spark):
    df = spark.createDataFrame([([[9.0, 9.0], [1.0, 2.0], [3.0, 4.0], [9.0, 9.0]],)], "t array<array<double>>")
    assert df.select(e.mean_pool(df["t"])).first()[0] == [2.0, 3.0]


def test_assembly(spark, tmp_path, rows):
    np.save(tmp_path / "shard_00000.npy", np.array([[1, 2], [3, 4]], np.float32))
    np.save(tmp_path / "shard_00001.npy", np.array([[5, 6]], np.float32))
    m = e.with_shard_status(manifest(spark, str(tmp_path)), sources.shard_vectors(spark, str(tmp_path)).select("shard_path"))
    whole = f.assemble_embeddings(m, sources.shard_vectors(spark, str(tmp_path)))
    assert [tuple(map(float, r["embedding"])) for r in whole.orderBy("row_index").collect()] == [(1, 2), (3, 4), (5, 6)]
    with pytest.raises(ValueError, match="x"):
        f.align(whole, spark.createDataFrame([("x",)], "entry_id string"))
    np.save(tmp_path / "shard_00001.npy", np.array([[5, 6, 7]], np.float32))
    with pytest.raises(ValueError, match="length"):
        f.assemble_embeddings(m, sources.shard_vectors(spark, str(tmp_path)))


def test_labels_and_top_k(spark, rows):
    labels = spark.createDataFrame([("a", "T1", "MF"), ("a", "T2", "MF"), ("b", "T1", "MF"), ("b", "T3", "CC")], "entry_id string, term string, branch string")
    assert rows(f.select_terms(labels, 1, 1)) == [("CC", "T3", 1), ("MF", "T1", 2)]
    assert rows(f.select_terms(labels, 2)) == [("MF", "T1", 2)]
    pairs = f.label_pairs(spark.createDataFrame([("a",), ("c",)], "entry_id string"), labels, labels)
    assert rows(pairs, "entry_id", "term") == [("a", "T1"), ("a", "T2")]
    folds = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "entry_id string, fold int")
    both = f.label_pairs(folds, labels, f.select_terms(labels, 1))
    got = {(r["term"], r["held_fold"]): (r["n_pos"], r["n_rows"]) for r in f.trainable_terms(both, folds).collect()}
    assert got == {("T1", -1): (2, 3), ("T2", -1): (1, 3), ("T3", -1): (1, 3), ("T2", 1): (1, 2), ("T3", 1): (1, 2)}
    scores = spark.createDataFrame([("p", [0.1, 0.9, 0.5])], "entry_id string, scores array<double>")
    assert rows(f.top_k_of_vectors(scores, ["A", "B", "C"], "MF", 2, 0.2), "term", "score") == [("B", 0.9), ("C", 0.5)]


def test_heads(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 4))
    y = x[:, 0] + 0.5 * x[:, 1] > 0
    vectors = spark.createDataFrame([(f"e{k}", [float(v) for v in r]) for k, r in enumerate(x)], "entry_id string, embedding array<float>")
    folds = spark.createDataFrame([(f"e{k}", k % 3) for k in range(120)], "entry_id string, fold int")
    labels = spark.createDataFrame([(f"e{k}", "UP" if y[k] else "DOWN", "MF") for k in range(120)], "entry_id string, term string, branch string")
    pairs = f.label_pairs(vectors, labels, f.select_terms(labels, 2))
    oof, heads = ml.cross_validate(vectors, folds, pairs, f.trainable_terms(pairs, folds), alpha=1e-3, steps=25)
    got = {(r["entry_id"], r["term"]): r["score"] for r in oof.collect()}
    assert len(got) == 240 and all(0 <= s <= 1 for s in got.values())
    right = sum((got[f"e{k}", "UP"] > got[f"e{k}", "DOWN"]) == y[k] for k in range(120))
    assert right > 110
    assert sorted(h.held_fold for h in heads) == [-1, 0, 1, 2]
    # The final heads are at the optimum: the gradient of the objective vanishes.
    head = next(h for h in heads if h.held_fold == -1)
    z = (x.astype(np.float32) - head.mean) / head.std
    up = head.terms.index("UP")
    cost = np.where(y, 120 / (2 * y.sum()), 120 / (2 * (~y).sum()))
    p = 1 / (1 + np.exp(-(z @ head.coef[:, up] + head.intercept[up])))
    gradient = z.T @ (cost * (p - y)) / 120 + 1e-3 * head.coef[:, up]
    assert np.abs(gradient).max() < 5e-3
    # A head's scaler does not see the rows of the fold that it will score.
    for h in heads:
        own = x[np.arange(120) % 3 != h.held_fold].astype(np.float32)
        assert np.allclose(h.mean, own.mean(axis=0), atol=1e-5) and np.allclose(h.std, own.std(axis=0), atol=1e-5)
    top = ml.predict_top_k(vectors, [head], top_k=1, min_score=0.5)
    assert top.count() <= 120 and top.select("entry_id").distinct().count() == top.count()


def test_tasks_put_batch_files_in_place(spark, tmp_path, monkeypatch):
    """The driver renames no file: it only clears the folder; each batch is one file with its rows in order."""
    rows = [(f"e{k:03d}", "ACDE" * (k % 5 + 1)) for k in range(30)]
    normalized = e.normalize_sequences(spark.createDataFrame(rows, "entry_id string, sequence string"))
    batches = e.batches_of(normalized, e.BatchConfig("train", str(tmp_path), 7)).persist()
    batches.count()
    told = []
    write = type(batches.write).parquet
    monkeypatch.setattr(type(batches.write), "parquet", lambda self, path, *a, **k: told.append(path) or write(self, path, *a, **k))
    sinks.write_batches(batches, str(tmp_path / "b"))
    assert told == []
    assert sorted(p.name for p in (tmp_path / "b").iterdir()) == [f"batch_{k:05d}.parquet" for k in range(5)]
    for k in range(5):
        got = [tuple(r) for r in spark.read.parquet(str(tmp_path / f"b/batch_{k:05d}.parquet")).select("entry_id", "sequence", "row_index_in_batch").collect()]
        assert got == [(*rows[i], i % 7) for i in range(7 * k, min(7 * k + 7, 30))]
