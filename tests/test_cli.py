"""A whole run of the command line over small files."""

from __future__ import annotations

import json
import os
from pathlib import Path

import pytest

from annofold import cli, storage
from annofold.cli import main

TERMS = ["T:1", "T:2", "T:3"]


@pytest.fixture(scope="module")
def home(tmp_path_factory):
    return tmp_path_factory.mktemp("run")


def test_whole_run(spark, home, monkeypatch):
    written = []
    scratch = storage.scratch_path
    monkeypatch.setattr(storage, "scratch_path", lambda spark: (written.append(scratch(spark)), written[-1])[1])
    for name in ("RAW", "PROCESSED", "ARTIFACTS", "REPORTS"):
        monkeypatch.setattr(cli, name, str(home / getattr(cli, name)))
    raw = home / "data" / "raw"
    raw.mkdir(parents=True)
    n = 24
    (raw / "train_sequences.fasta").write_text("".join(f">sp|E{k}|N OX={k % 3}\n{'M' * (50 * k + 1)}\n" for k in range(n)))
    (raw / "testsuperset.fasta").write_text("".join(f">X{k} {k}\nMMM\n" for k in range(4)))
    (raw / "train_terms.tsv").write_text("EntryID\tterm\taspect\n" + "".join(f"E{k}\tT:{2 + k % 2}\tP\n" for k in range(n)))
    (raw / "train_taxonomy.tsv").write_text("".join(f"E{k}\t{k % 3}\n" for k in range(n)))
    (raw / "testsuperset-taxon-list.tsv").write_text("ID\tSpecies\n0\tzero\n1\tone\n")
    stanza = "[Term]\nid: {}\nname: x\nnamespace: biological_process\n{}\n"
    (raw / "go-basic.obo").write_text(stanza.format("T:1", "") + stanza.format("T:2", "is_a: T:1 ! x") + stanza.format("T:3", "is_a: T:1 ! x"))
    assert main(["verify-raw-files"]) == 1
    assert main(["verify-raw-files", "--allow-missing"]) == 0
    assert main(["build-tables"]) == 0
    report = json.loads((home / "artifacts/reports/build_tables_report.json").read_text())
    assert report["counts"]["train_sequences"] == n and report["validation"]["test_taxon_without_species"] == 2
    assert main(["build-ontology"]) == 0
    assert spark.read.parquet(str(home / "data/processed/train_terms_closure.parquet")).count() == 2 * n
    assert main(["make-folds", "--n-folds", "3", "--train-terms", str(home / "data/processed/train_terms_closure.parquet")]) == 0
    assert main(["prepare-embedding-batches", "--batch-size", "10"]) == 0

    # An encoder as a user would bring it: a module that the workers can import.
    (home / "toy_encoder.py").write_text(
        "import numpy as np\n\n"
        "def load():\n"
        "    def encode(texts):\n"
        "        n = np.array([len(t) // 50 for t in texts])\n"
        "        return np.stack([4.0 * (n % 2), np.sin(n), np.cos(n)], axis=1)\n"
        "    return encode\n"
    )
    spark.sparkContext.addPyFile(str(home / "toy_encoder.py"))
    for split in ("train", "test"):
        root = f"{home}/artifacts/embeddings/{split}"
        options = ["--root", root, "--encoder", "toy_encoder:load", "--max-sequence-length", "2000"]
        assert main(["extract-embeddings", *options, "--completed-at", "2020-01-01"]) == 0
        manifest = spark.read.csv(f"{root}/manifest.csv", header=True).toPandas()
        assert all(os.path.isfile(p) for c in ("batch_path", "shard_path") for p in manifest[c])
        assert set(manifest["completed_at"]) == {"2020-01-01"}
        times = {p: os.path.getmtime(p) for p in manifest["shard_path"]}
        assert main(["extract-embeddings", *options]) == 0  # nothing is left to do
        assert times == {p: os.path.getmtime(p) for p in times}
    assert main(["prepare-embedding-batches", "--batch-size", "10"]) == 0
    assert set(spark.read.csv(f"{home}/artifacts/embeddings/train/manifest.csv", header=True).toPandas()["status"]) == {"complete"}

    assert main(["run-homology"]) == 1
    assert main(["run-homology", "--mode", "prepare"]) == 0
    (home / "artifacts/retrieval").mkdir(parents=True)
    pairs = [(f"E{a}", f"E{b}") for a in range(n) for b in range(n) if (a - b) % 2 == 0]
    (home / "artifacts/retrieval/train_vs_train.tsv").write_text("".join(f"{a}\t{b}\t90\t1e-9\t{90 if a != b else 100}\t1\t1\n" for a, b in pairs))
    (home / "artifacts/retrieval/test_vs_train.tsv").write_text("".join(f"X{k}\tE{k}\t90\t1e-9\t50\t1\t1\n" for k in range(4)))
    assert main(["run-homology"]) == 0
    assert main(["train-supervised", "--min-label-count", "2", "--max-iter", "8", "--train-embeddings", str(home / "artifacts/embeddings/train"), "--test-embeddings", str(home / "artifacts/embeddings/test")]) == 0
    assert main(["calibrate-predictions", "--score-repaired-oof"]) == 0
    assert main(["blend-predictions", "--supervised-scale", "0.9"]) == 0
    assert main(["score-predictions"]) == 0
    scores = {r["branch"]: r for r in spark.read.csv(f"{home}/artifacts/reports/scores.csv", header=True, inferSchema=True).collect()}
    assert scores["BP"]["fmax"] > 0.8 and scores["MF"]["fmax"] == 0
    assert main(["make-submission", "--output", str(home / "submissions/submission.tsv")]) == 0
    report = json.loads((home / "artifacts/reports/submission.json").read_text())
    assert report["valid"] and report["covered_test_entry_count"] == 4
    lines = [x.split("\t") for x in (home / "submissions/submission.tsv").read_text().splitlines()]
    assert lines == sorted(lines, key=lambda x: (x[0], -float(x[2]), x[1]))
    assert {x[1] for x in lines} <= set(TERMS) and all(0 <= float(x[2]) <= 1 for x in lines)
    assert main(["make-submission", "--output", str(home / "submissions/two.tsv"), "--require-all-test-entries", "--top-k-total", "1"]) == 0
    # No command leaves anything of what it wrote on its way.
    assert not [p for p in written if Path(p.removeprefix("file:")).exists()] and len(written) > 20
