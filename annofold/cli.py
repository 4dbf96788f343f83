"""Command line: ``python -m annofold.cli COMMAND``. Each command reads tables, runs operators and writes tables and a report.

All paths may lie in any store that Spark reads; only JSON reports are written by the driver.
"""

from __future__ import annotations

import argparse
import importlib
import os
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annofold import sinks, sources
from annofold.operators import embeddings as emb
from annofold.operators import features as feat
from annofold.operators import folds as fold_ops
from annofold.operators import hits as hit_ops
from annofold.operators import metrics
from annofold.operators import models as ml
from annofold.operators import ontology as onto
from annofold.operators import predictions as pred
from annofold.operators import submission as sub
from annofold.operators import tables
from annofold.schemas import BRANCHES
from annofold.sources.raw_files import REQUIRED_FILES
from annofold.storage import drop_intermediates, settled

RAW, PROCESSED, ARTIFACTS, REPORTS = "data/raw", "data/processed", "artifacts", "artifacts/reports"


def session() -> SparkSession:
    return SparkSession.builder.appName("annofold").getOrCreate()


def records(df: DataFrame) -> list[dict]:
    """Rows of a small report table as dictionaries."""
    return [r.asDict(recursive=True) for r in df.collect()]


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table and go on from the file, so that later uses do not compute it again."""
    sinks.write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def missing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that no file system of the session has."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if not path.getFileSystem(conf).exists(path):
            out.append(p)
    return out


def require_paths(spark: SparkSession, paths: Sequence[str]) -> None:
    if missing := missing_paths(spark, paths):
        raise FileNotFoundError(f"missing inputs: {', '.join(missing)}")


def download_data(a: argparse.Namespace) -> int:
    if a.source:
        sources.copy_required_files(a.source, a.raw_dir, REQUIRED_FILES, a.overwrite)
    report = sources.raw_file_report(a.raw_dir)
    print(sources.raw_file_summary(report))
    return 0 if report["all_present"] else 1


def verify_raw_files(a: argparse.Namespace) -> int:
    report = sources.raw_file_report(a.raw_dir)
    sinks.write_json(report, a.report)
    print(sources.raw_file_summary(report))
    return 0 if report["all_present"] or a.allow_missing else 1


def build_tables(a: argparse.Namespace) -> int:
    spark = session()
    out = a.processed_dir
    train = stored(sources.fasta(spark, f"{a.raw_dir}/train_sequences.fasta"), f"{out}/train_sequences.parquet")
    test = stored(sources.fasta(spark, f"{a.raw_dir}/testsuperset.fasta"), f"{out}/test_sequences.parquet")
    labels = stored(sources.labels_tsv(spark, f"{a.raw_dir}/train_terms.tsv"), f"{out}/train_terms_clean.parquet")
    taxonomy = stored(sources.taxonomy_tsv(spark, f"{a.raw_dir}/train_taxonomy.tsv"), f"{out}/taxonomy_train.parquet")
    taxa = sources.taxon_list_tsv(spark, f"{a.raw_dir}/testsuperset-taxon-list.tsv")
    tables.require_unique_ids(train, "train_sequences")
    tables.require_unique_ids(test, "test_sequences")
    tables.require_labelled_known(labels, train)
    test_taxa = stored(tables.test_taxonomy(test, taxa), f"{out}/taxonomy_test.parquet")
    sinks.write_csv(tables.label_frequency(labels), f"{a.reports_dir}/label_frequency.csv")
    summary = {"train": records(tables.sequence_summary(train))[0], "test": records(tables.sequence_summary(test))[0]}
    sinks.write_json(summary, f"{a.reports_dir}/sequence_summary.json")
    issues = tables.ingestion_issues(train, taxonomy, test_taxa)
    sinks.write_parquet(issues, f"{a.reports_dir}/ingestion_issues.parquet")
    report = {
        "counts": {k: df.count() for k, df in (("train_sequences", train), ("test_sequences", test), ("train_terms_clean", labels), ("taxonomy_train", taxonomy), ("taxonomy_test", test_taxa))},
        "branch_label_counts": {r["branch"]: r["n"] for r in labels.groupBy("branch").agg(F.count_distinct("term").alias("n")).collect()},
        "validation": {r["issue"]: r["count"] for r in issues.groupBy("issue").count().collect()},
    }
    sinks.write_json(report, f"{a.reports_dir}/build_tables_report.json")
    return 0


def build_ontology(a: argparse.Namespace) -> int:
    spark = session()
    require_paths(spark, [a.obo, a.train_terms])
    o = onto.build_ontology(*sources.obo(spark, a.obo))
    out = a.processed_dir
    terms = stored(o.terms, f"{out}/go_terms.parquet")
    edges = stored(o.edges, f"{out}/go_edges.parquet")
    ancestors = stored(o.ancestors, f"{out}/go_ancestors.parquet")
    alt_ids = stored(o.alt_ids, f"{out}/go_alt_ids.parquet")
    labels = spark.read.parquet(a.train_terms)
    closed = stored(onto.close_labels(labels, terms, ancestors, alt_ids), f"{out}/train_terms_closure.parquet")
    issues: dict[str, list[str]] = {}
    for r in onto.label_issues(labels, terms, alt_ids, o.all_terms).collect():
        issues.setdefault(r["issue"], []).append(r["term"])
    report = {
        "counts": {"terms": terms.count(), "edges": edges.count(), "ancestors": ancestors.count(), "alt_ids": alt_ids.count(), "closed": closed.count()},
        "edge_filtering": {r["drop_reason"]: r["n"] for r in o.edge_drops.collect()},
        "closed_rows_by_branch": {r["branch"]: r["count"] for r in closed.groupBy("branch").count().collect()},
        "label_issues": {k: sorted(v) for k, v in issues.items()},
    }
    sinks.write_json(report, a.report)
    return 0


def make_folds(a: argparse.Namespace) -> int:
    spark = session()
    sequences = spark.read.parquet(a.train_sequences)
    clusters = sources.string_table(spark, a.cluster_file) if a.cluster_file else None
    folds = stored(fold_ops.make_folds(sequences, clusters, fold_ops.FoldConfig(a.n_folds, a.seed)), a.output)
    validation = records(fold_ops.validate_folds(folds))[0]
    report = {"n_folds_requested": a.n_folds, "seed": a.seed, "validation": validation, "fold_sizes": records(fold_ops.fold_sizes(folds))}
    if a.train_terms:
        report["labels_by_fold_branch"] = records(fold_ops.fold_label_report(folds, spark.read.parquet(a.train_terms)))
    sinks.write_json(report, a.report)
    return 1 if validation["duplicate_entry_count"] or validation["cluster_leak_count"] else 0


def prepare_embedding_batches(a: argparse.Namespace) -> int:
    spark = session()
    output_root = a.output_root if "://" in a.output_root else os.path.abspath(a.output_root)
    for split, path in (("train", a.train_sequences), ("test", a.test_sequences)):
        root = f"{output_root}/{split}"
        config = emb.BatchConfig(split, root, a.batch_size, a.model_name)
        normalized = emb.normalize_sequences(spark.read.parquet(path))
        sinks.write_batches(emb.batches_of(normalized, config), f"{root}/batches")
        manifest = emb.create_manifest(normalized, config)
        if not missing_paths(spark, [root]):
            manifest = emb.with_shard_status(manifest, sources.shard_list(spark, root))
        sinks.write_manifest(manifest, f"{root}/manifest.csv")
        print(records(emb.manifest_summary(manifest))[0])
    return 0


def extract_embeddings(a: argparse.Namespace) -> int:
    """Encode the batches of a prepared folder that have no shard yet, and complete its manifest."""
    spark = session()
    module, _, name = a.encoder.partition(":")
    load_encoder = getattr(importlib.import_module(module), name)
    root = a.root if "://" in a.root else os.path.abspath(a.root)
    path = f"{root}/manifest.csv"
    require_paths(spark, [path, f"{root}/batches"])
    manifest = emb.with_shard_status(sources.manifest_csv(spark, path), sources.shard_list(spark, root))
    manifest = settled(manifest)
    done = None if a.overwrite else manifest.filter("status = 'complete'").select("batch_id")
    batches = spark.read.parquet(f"{root}/batches")
    vectors = emb.extract_embeddings(batches, load_encoder, done, a.inference_batch_size, a.max_sequence_length or None)
    shards = sinks.write_shards(vectors, root)
    manifest = settled(emb.complete_batches(manifest, shards, a.completed_at))
    sinks.write_manifest(manifest, path)
    print(records(emb.manifest_summary(manifest))[0])
    return 0


def run_homology(a: argparse.Namespace) -> int:
    spark = session()
    if a.mode == "prepare":
        needed = {"required": ["query_id", "target_id"], "recommended": ["bitscore", "evalue", "pident", "qcov", "tcov"], "aliases": hit_ops.HIT_ALIASES}
        sinks.write_json({"hit_columns": needed, "inputs": {"valid_hits": a.valid_hits, "test_hits": a.test_hits}}, a.report)
        print("search the training sequences against themselves and the test sequences against them, then run --mode aggregate")
        return 0
    if missing := missing_paths(spark, [a.valid_hits, a.test_hits, a.train_terms, a.folds]):
        print("missing inputs: " + ", ".join(missing))
        return 1
    labels, folds = spark.read.parquet(a.train_terms), spark.read.parquet(a.folds)
    report: dict = {"parameters": {k: v for k, v in vars(a).items() if k != "run"}}
    kept = {
        "oof": hit_ops.filter_oof_hits(sources.hit_table(spark, a.valid_hits), folds),
        "test": hit_ops.filter_test_hits(sources.hit_table(spark, a.test_hits), labels, not a.allow_test_self_hits),
    }
    for split, hits in kept.items():
        # The hits never go back to the input's own path: weights must not be made twice.
        hits = stored(hits, f"{a.output_dir}/{split}_hits.parquet")
        best = hit_ops.transfer_top_k(hits, labels, a.max_hits_per_query, a.min_hit_weight, a.max_predictions_per_query_branch)
        if a.normalize_branch_max:
            best = pred.normalize_by_branch(best)
        predictions = stored(best, f"{a.output_dir}/homology_{split}.parquet")
        report[split] = records(hit_ops.transfer_summary(hits, predictions))[0]
    sinks.write_json(report, a.report)
    return 0


def train_supervised(a: argparse.Namespace) -> int:
    spark = session()
    vectors = {}
    for split, root in (("train", a.train_embeddings), ("test", a.test_embeddings)):
        manifest = sources.manifest_csv(spark, f"{root}/manifest.csv")
        manifest = emb.with_shard_status(manifest, sources.shard_list(spark, root))
        vectors[split] = feat.assemble_embeddings(manifest, sources.shard_vectors(spark, root))
    labels = spark.read.parquet(a.train_terms).filter(F.col("branch").isin(*a.branches))
    folds = spark.read.parquet(a.folds).select("entry_id", "fold")
    train = feat.align(vectors["train"], folds)
    most = {"MF": a.max_labels_mf, "BP": a.max_labels_bp, "CC": a.max_labels_cc}
    selected = feat.select_terms(labels, a.min_label_count, most)
    pairs = feat.label_pairs(folds, labels, selected)
    heads = f"{a.output_dir}/heads"
    oof = ml.cross_validate_stored(train, folds, pairs, feat.trainable_terms(pairs, folds), heads, a.top_k, a.min_score, a.alpha, a.max_iter)
    oof = stored(pred.collapse_scores(oof), f"{a.output_dir}/supervised_oof.parquet")
    test = pred.collapse_scores(ml.predict_stored(vectors["test"].select("entry_id", "embedding"), heads, [-1], a.top_k, a.min_score))
    n_test = sinks.write_parquet_counted(test, f"{a.output_dir}/supervised_test.parquet")
    scores = records(metrics.score_branches(labels, oof))
    report = {"parameters": {k: v for k, v in vars(a).items() if k != "run"}, "selected_labels": records(selected.groupBy("branch").count()), "test_rows": n_test, "cv_scores": scores}
    sinks.write_json(report, a.report)
    return 0


def calibrate_predictions(a: argparse.Namespace) -> int:
    spark = session()
    require_paths(spark, [a.oof_predictions, a.test_predictions, a.truth, a.go_terms, a.go_ancestors])
    read = spark.read.parquet
    truth, terms, ancestors, oof = read(a.truth), read(a.go_terms), read(a.go_ancestors), read(a.oof_predictions)
    calibration = stored(pred.fit_calibration(oof, truth, a.method), f"{a.output_dir}/calibration.parquet")
    report: dict = {"calibration": records(calibration), "rows": {}}
    # The test split is scaled by what was fitted on the out-of-fold split.
    for split, given in (("oof", oof), ("test", read(a.test_predictions))):
        repaired = pred.repair_by_branch(pred.apply_calibration(given, calibration), ancestors, terms, a.top_k_per_branch)
        report["rows"][split] = sinks.write_parquet_counted(repaired, f"{a.output_dir}/supervised_{split}_repaired.parquet")
    if a.score_repaired_oof:
        report["repaired_scores"] = records(metrics.score_branches(truth, read(f"{a.output_dir}/supervised_oof_repaired.parquet")))
    sinks.write_json(report, a.report)
    return 0


def blend_predictions(a: argparse.Namespace) -> int:
    spark = session()
    read = spark.read.parquet

    def blend(one: str, two: str) -> DataFrame:
        return pred.blend_max(read(one), read(two), a.homology_scale, a.supervised_scale, a.supervised_top_k_per_branch)

    require_paths(spark, [a.homology_test, a.supervised_test])
    report: dict = {"parameters": {k: v for k, v in vars(a).items() if k != "run"}}
    if not a.skip_oof:
        require_paths(spark, [a.homology_oof, a.supervised_oof, a.truth])
        oof = stored(blend(a.homology_oof, a.supervised_oof), f"{a.output_dir}/ensemble_oof.parquet")
        report["cv_scores"] = records(metrics.score_branches(read(a.truth), oof))
    report["test_rows"] = sinks.write_parquet_counted(blend(a.homology_test, a.supervised_test), f"{a.output_dir}/ensemble_test.parquet")
    sinks.write_json(report, a.report)
    return 0


def score_predictions(a: argparse.Namespace) -> int:
    spark = session()
    terms = sources.typed_table(spark, a.go_terms) if a.go_terms else None
    scores = metrics.score_branches(
        sources.typed_table(spark, a.truth), sources.typed_table(spark, a.predictions), terms, a.threshold_step, a.average
    )
    sinks.write_csv(scores.coalesce(1), a.output)
    scores.show()
    return 0


def make_submission(a: argparse.Namespace) -> int:
    spark = session()
    require_paths(spark, [a.predictions, a.test_sequences, a.go_terms])
    entries, terms = spark.read.parquet(a.test_sequences), spark.read.parquet(a.go_terms)
    shaped = sub.shape_submission(spark.read.parquet(a.predictions), entries, terms, a.top_k_per_branch, a.top_k_total)
    shaped = stored(shaped, f"{a.output}.parquet")
    report = records(sub.validate_submission(shaped, entries, terms, a.require_all_test_entries))[0]
    missing = sub.missing_entries(shaped, entries)
    report["missing_test_entry_preview"] = [r[0] for r in missing.orderBy("entry_id").limit(20).collect()]
    sinks.write_submission_file(shaped, a.output)
    sinks.write_json(report, a.report)
    return 0 if report["valid"] else 1


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="annofold")
    commands = p.add_subparsers(dest="command", required=True)

    def command(run, report: str | None = None, **options) -> None:
        c = commands.add_parser(run.__name__.replace("_", "-"))
        c.set_defaults(run=run)
        if report:
            options["report"] = f"{REPORTS}/{report}.json"
        for name, default in options.items():
            flag = "--" + name.replace("_", "-")
            if isinstance(default, bool):
                c.add_argument(flag, action="store_true")
            elif isinstance(default, tuple):
                c.add_argument(flag, choices=default, default=default[0])
            elif isinstance(default, list):
                c.add_argument(flag, nargs="+", choices=default, default=default)
            else:
                c.add_argument(flag, type=type(default) if default is not None else str, default=default)

    predictions = f"{ARTIFACTS}/predictions"
    closure, folds = f"{PROCESSED}/train_terms_closure.parquet", f"{PROCESSED}/folds_clustered.parquet"
    terms = f"{PROCESSED}/go_terms.parquet"
    sequences = {"train_sequences": f"{PROCESSED}/train_sequences.parquet", "test_sequences": f"{PROCESSED}/test_sequences.parquet"}
    command(download_data, source=None, raw_dir=RAW, overwrite=False)
    command(verify_raw_files, "raw_files", raw_dir=RAW, allow_missing=False)
    command(build_tables, raw_dir=RAW, processed_dir=PROCESSED, reports_dir=REPORTS)
    command(build_ontology, "ontology", obo=f"{RAW}/go-basic.obo", train_terms=f"{PROCESSED}/train_terms_clean.parquet", processed_dir=PROCESSED)
    command(make_folds, "folds", train_sequences=sequences["train_sequences"], train_terms=None, cluster_file=None, n_folds=5, seed=42, output=folds)
    command(prepare_embedding_batches, **sequences, output_root=f"{ARTIFACTS}/embeddings", batch_size=emb.BATCH_SIZE, model_name=emb.MODEL_NAME)
    command(
        extract_embeddings, root=f"{ARTIFACTS}/embeddings/train", encoder="my_encoder:load", inference_batch_size=emb.INFERENCE_BATCH_SIZE,
        max_sequence_length=emb.MAX_SEQUENCE_LENGTH, completed_at="", overwrite=False,
    )
    command(
        run_homology, "homology", mode=("aggregate", "prepare"), valid_hits=f"{ARTIFACTS}/retrieval/train_vs_train.tsv",
        test_hits=f"{ARTIFACTS}/retrieval/test_vs_train.tsv", train_terms=closure, folds=folds, output_dir=predictions, max_hits_per_query=100,
        min_hit_weight=0.0, max_predictions_per_query_branch=100, normalize_branch_max=False, allow_test_self_hits=False,
    )
    command(
        train_supervised, "supervised", train_embeddings=f"{ARTIFACTS}/embeddings/train", test_embeddings=f"{ARTIFACTS}/embeddings/test",
        train_terms=closure, folds=folds, output_dir=predictions, branches=list(BRANCHES), min_label_count=50, max_labels_mf=feat.MAX_LABELS["MF"],
        max_labels_bp=feat.MAX_LABELS["BP"], max_labels_cc=feat.MAX_LABELS["CC"], top_k=100, min_score=0.0, alpha=ml.ALPHA, max_iter=50,
    )
    command(
        calibrate_predictions, "calibration", oof_predictions=f"{predictions}/supervised_oof.parquet", test_predictions=f"{predictions}/supervised_test.parquet",
        truth=closure, go_terms=terms, go_ancestors=f"{PROCESSED}/go_ancestors.parquet", output_dir=predictions, method=("max", "none"),
        top_k_per_branch=100, score_repaired_oof=False,
    )
    command(
        blend_predictions, "blend", homology_oof=f"{predictions}/homology_oof.parquet", homology_test=f"{predictions}/homology_test.parquet",
        supervised_oof=f"{predictions}/supervised_oof_repaired.parquet", supervised_test=f"{predictions}/supervised_test_repaired.parquet", truth=closure,
        output_dir=predictions, homology_scale=1.0, supervised_scale=0.05, supervised_top_k_per_branch=25, skip_oof=False,
    )
    command(
        score_predictions, predictions=f"{predictions}/ensemble_oof.parquet", truth=closure, go_terms=None, output=f"{REPORTS}/scores.csv",
        threshold_step=0.01, average=metrics.AVERAGES,
    )
    command(
        make_submission, "submission", predictions=f"{predictions}/supervised_test_repaired.parquet", test_sequences=sequences["test_sequences"],
        go_terms=terms, output="submissions/submission.tsv", top_k_per_branch=100, top_k_total=0, require_all_test_entries=False,
    )
    return p


def main(argv: Sequence[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        return a.run(a)
    finally:
        # A command's results are written by now; what it wrote on the way is not read again.
        spark = SparkSession.getActiveSession()
        if spark is not None:
            drop_intermediates(spark)


if __name__ == "__main__":
    sys.exit(main())
