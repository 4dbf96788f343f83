"""Registered queries of the library's own operators and their DuckDB SQL.

A key starts with the id of the operator that it applies. Doubles are rounded to nine places on
both sides, since sums come in any order.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annofold.functions import length_bin, stable_hash
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
from annofold.operators.tables import label_frequency, sequence_summary
from annofold.plans import adapters as ad
from annofold.plans.file_queries import FILE_QUERIES
from annofold.plans.oracle import ORACLE_SQL
from annofold.schemas import with_branch
from annofold.sources.fasta import parsed_header
from annofold.storage import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PLACES = 9

__all__ = ["ORACLE_SQL", "QUERIES"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.round(c, PLACES))
    return df


def _ontology(spark: SparkSession, sf_dir: str) -> onto.OntologyTables:
    return onto.build_ontology(ad.stanzas(spark, sf_dir), ad.raw_edges(spark, sf_dir), validate=False)


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onto.active_terms(onto.term_table(ad.stanzas(spark, sf_dir)))


# Sources and scalar functions


@query
def src01_parse_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = ad.headers(spark, sf_dir).select("header", parsed_header(F.col("header")).alias("h"))
    return parsed.select("header", "h.entry_id", "h.database", "h.uniprot_name", "h.taxon_id")


@query
def prj09_length_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = ad.sequences(spark, sf_dir).select(length_bin(F.col("length")).alias("length_bin"))
    return bins.groupBy("length_bin").agg(F.count(F.lit(1)).alias("n"))


@query
def prj10_stable_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.sequences(spark, sf_dir).select("entry_id", stable_hash(F.col("entry_id"), 42).alias("hash"))


@query
def prj06_prepare_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hit_ops.prepare_labels(ad.truth(spark, sf_dir))


@query
def prj05_branch_from_aspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that state an aspect only."""
    aspect = F.when(F.col("branch") == "MF", F.lit("F")).when(F.col("branch") == "BP", F.lit("P")).otherwise("C")
    stated = ad.truth(spark, sf_dir).select("entry_id", "term", aspect.alias("aspect"))
    return with_branch(stated, "labels").select("entry_id", "term", "branch").distinct()


def _test_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    taxa = spark.createDataFrame([("en", "first"), ("fr", "second"), ("it", "third")], "taxon_id string, species string")
    return tables.test_taxonomy(ad.sequences(spark, sf_dir), taxa)


@query
def joi16_test_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _test_taxonomy(spark, sf_dir)


@query
def agg21_ingestion_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    taxonomy = ad.customers(spark, sf_dir)
    return tables.ingestion_issues(ad.sequences(spark, sf_dir), taxonomy, _test_taxonomy(spark, sf_dir))


@query
def agg01_label_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_frequency(ad.truth(spark, sf_dir))


@query
def agg02_sequence_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sequence_summary(ad.sequences(spark, sf_dir)), "mean_length", "median_length")


# Hits


@query
def prj02_normalize_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hit_ops.normalize_hits(ad.hits(spark, sf_dir)), "evalue", "qcov", "tcov")


def _weights(df: DataFrame) -> DataFrame:
    out = hit_ops.add_hit_weights(df).select("query_id", "target_id", "hit_weight")
    return rounded(out, "hit_weight")


@query
def dom01_hit_weights_bitscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(ad.hits(spark, sf_dir))


@query
def dom01_hit_weights_pident(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(ad.hits(spark, sf_dir).drop("bits"))


@query
def dom01_hit_weights_evalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(ad.hits(spark, sf_dir).drop("bits", "pident"))


@query
def dom01_hit_weights_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(ad.hits(spark, sf_dir).withColumn("score", F.when(F.col("pident") > 20, F.col("pident") / 100)))


@query
def dom02_oof_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = hit_ops.filter_oof_hits(ad.hits(spark, sf_dir), ad.folds_of_orders(spark, sf_dir))
    return rounded(kept.select("query_id", "target_id", "query_fold", "target_fold", "hit_weight"), "hit_weight")


@query
def dom03_test_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = hit_ops.filter_test_hits(ad.hits(spark, sf_dir), ad.truth(spark, sf_dir))
    return rounded(kept.select("query_id", "target_id", "hit_weight"), "hit_weight")


@query
def win01_top_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = hit_ops.limit_hits(hit_ops.add_hit_weights(ad.hits(spark, sf_dir)), 2)
    return rounded(best.select("query_id", "target_id", "bitscore", "hit_weight"), "hit_weight")


@query
def agg03_noisy_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = hit_ops.filter_oof_hits(ad.hits(spark, sf_dir), ad.folds_of_orders(spark, sf_dir))
    return rounded(hit_ops.aggregate_hit_labels(kept, ad.truth(spark, sf_dir)), "score", "best_hit_weight")


@query
def agg05_homology_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: out-of-fold label transfer, the best three labels per entry and branch."""
    kept = hit_ops.filter_oof_hits(ad.hits(spark, sf_dir), ad.folds_of_orders(spark, sf_dir))
    best = hit_ops.transfer_top_k(kept, ad.truth(spark, sf_dir), max_predictions=3)
    return rounded(best.select("entry_id", "term", "branch", "score", "n_hits"), "score")


@query
def agg16_transfer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits, predictions = hit_ops.test_transfer(ad.hits(spark, sf_dir), ad.truth(spark, sf_dir))
    return rounded(hit_ops.transfer_summary(hits, predictions), "min_score", "max_score")


# Ontology


@query
def prj13_edge_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onto.edge_drop_counts(onto.classify_edges(ad.raw_edges(spark, sf_dir), _terms(spark, sf_dir)))


@query
def rec01_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ontology(spark, sf_dir).ancestors


@query
def agg20_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onto.parents_of(_ontology(spark, sf_dir).edges).select("child_term", F.array_join("parents", ",").alias("parents"))


@query
def dom06_label_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _ontology(spark, sf_dir)
    return onto.close_labels(ad.raw_labels(spark, sf_dir), o.terms, o.ancestors, o.alt_ids)


@query
def agg22_label_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = _terms(spark, sf_dir)
    all_terms = onto.term_table(ad.stanzas(spark, sf_dir))
    return onto.label_issues(ad.raw_labels(spark, sf_dir), terms, onto.alt_id_table(terms, validate=False), all_terms)


# Folds


@query
def seq01_folds_singleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_ops.make_folds(ad.sequences(spark, sf_dir)).select("entry_id", "fold", "length_bin", "stratification_key")


@query
def seq01_folds_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = fold_ops.make_folds(ad.sequences(spark, sf_dir), ad.clusters(spark, sf_dir))
    return folds.select("entry_id", "fold", "cluster_id", "cluster_source")


@query
def agg14_fold_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = ad.folds_of_orders(spark, sf_dir).withColumn("cluster_id", F.substring("entry_id", 1, 3))
    return fold_ops.validate_folds(folds)


@query
def agg15_fold_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_ops.fold_label_report(ad.folds_of_orders(spark, sf_dir), ad.truth(spark, sf_dir))


# Predictions


@query
def agg06_collapse_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pred.collapse_scores(ad.supervised(spark, sf_dir)), "score")


@query
def agg12_branch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pred.branch_stats(ad.predictions(spark, sf_dir)), "raw_score_min", "raw_score_max", "raw_score_mean")


@query
def win02_prune_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pred.prune_top_k(pred.collapse_scores(ad.predictions(spark, sf_dir)), 2), "score")


@query
def win05_branch_max_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    halved = pred.collapse_scores(ad.predictions(spark, sf_dir)).withColumn("score", F.col("score") / 2)
    return rounded(pred.normalize_by_branch(halved), "score")


@query
def dom07_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = ad.predictions(spark, sf_dir).drop("branch")
    return rounded(pred.canonical_predictions(stated, _terms(spark, sf_dir)), "score")


@query
def dom08_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _ontology(spark, sf_dir)
    return rounded(pred.repair_hierarchy(ad.predictions(spark, sf_dir), o.ancestors, o.terms), "score")


@query
def dom09_repair_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _ontology(spark, sf_dir)
    return rounded(pred.repair_by_branch(ad.predictions(spark, sf_dir), o.ancestors, o.terms, 3), "score")


@query
def dom10_blend_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [ad.predictions(spark, sf_dir), ad.supervised(spark, sf_dir)]
    return rounded(pred.blend_mean(frames, _terms(spark, sf_dir), [3.0, 1.0]), "score")


@query
def dom11_blend_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pred.blend_max(ad.predictions(spark, sf_dir), ad.supervised(spark, sf_dir), 0.5, 0.8, 1), "score")


@query
def dom12_calibrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    halved = ad.predictions(spark, sf_dir).withColumn("score", F.col("score") / 2)
    calibration = pred.fit_calibration(halved, ad.truth(spark, sf_dir))
    return rounded(pred.collapse_scores(pred.apply_calibration(halved, calibration, validate=False), halved.count()), "score")


# Metrics


_SCORE_COLUMNS = ("fmax", "threshold", "precision", "recall", "mean_fmax")


@query
def dom16_fmax_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = metrics.score_branches(ad.truth(spark, sf_dir), ad.predictions(spark, sf_dir), validate=False)
    return rounded(scores, *_SCORE_COLUMNS)


@query
def dom16_fmax_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = metrics.score_branches(ad.truth(spark, sf_dir), ad.predictions(spark, sf_dir), average="micro", validate=False)
    return rounded(scores, *_SCORE_COLUMNS)


@query
def dom15_score_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = metrics.score_branch(ad.truth(spark, sf_dir), ad.predictions(spark, sf_dir), "BP")
    return rounded(scores, *(c for c in _SCORE_COLUMNS if c != "mean_fmax"))


@query
def agg13_fit_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = pred.fit_calibration(ad.predictions(spark, sf_dir), ad.truth(spark, sf_dir), average="micro")
    out = fitted.select("branch", "fmax", "raw_score_min", "raw_score_max", "raw_score_mean", "prediction_rows", "method", "scale")
    return rounded(out, "fmax", "raw_score_min", "raw_score_max", "raw_score_mean", "scale")


# Submission


def _submission_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _terms(spark, sf_dir).filter("term != 'T00001'")


@query
def dom17_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = ad.folds_of_orders(spark, sf_dir)
    stated = ad.predictions(spark, sf_dir)
    rows = stated.count()
    given = pred.collapse_scores(stated, rows)
    return rounded(sub.shape_submission(given, entries, _submission_terms(spark, sf_dir), 2, 3, rows), "score")


@query
def agg18_submission_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = ad.customers(spark, sf_dir)
    return sub.validate_submission(ad.supervised(spark, sf_dir), entries, _submission_terms(spark, sf_dir))


@query
def set06_missing_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sub.missing_entries(ad.supervised(spark, sf_dir), ad.customers(spark, sf_dir))


# Embeddings and heads


@query
def dom18_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = emb.BatchConfig("train", "artifacts/embeddings/train", 64)
    return emb.create_manifest(emb.normalize_sequences(ad.sequences(spark, sf_dir)), config)


@query
def agg17_manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = emb.BatchConfig("train", "artifacts/embeddings/train", 64)
    manifest = emb.create_manifest(emb.normalize_sequences(ad.sequences(spark, sf_dir)), config)
    done = manifest.filter("batch_id < 'batch_00003'").select("shard_path")
    return emb.manifest_summary(emb.with_shard_status(manifest, done)).select(
        "n_sequences", "n_batches", "n_complete", "n_pending", "n_pending_batches"
    )


@query
def agg10_select_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.select_terms(ad.truth(spark, sf_dir), 5, {"MF": 15, "BP": 25, "CC": 10})


def _vector_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.vectors(spark, sf_dir).select("entry_id", F.col("label").alias("term"), F.lit("MF").alias("branch"))


def _vector_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = ad.vectors(spark, sf_dir)
    return entries.select("entry_id", F.pmod(F.col("entry_id").cast("long"), F.lit(3)).cast("int").alias("fold"))


@query
def agg11_trainable_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _vector_labels(spark, sf_dir)
    selected = feat.select_terms(labels, 2)
    return feat.trainable_terms(feat.label_pairs(labels, labels, selected), _vector_folds(spark, sf_dir), 2)


@query
def win07_topk_from_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = ad.vectors(spark, sf_dir).select("entry_id", F.col("embedding").alias("scores"))
    best = feat.top_k_of_vectors(scores, [f"L{k:02d}" for k in range(64)], "MF", 5, 0.05)
    return best.withColumn("score", F.round("score", 6))


@query
def joi21_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of those documents that have one."""
    vectors = ad.vectors(spark, sf_dir)
    wanted = ad.sequences(spark, sf_dir).select("entry_id")
    return feat.align(vectors, wanted, validate=False).select("entry_id", F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first"))


@query
def ml08_mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector read as eight tokens of eight numbers, pooled without the first and last token."""
    tokens = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.slice(F.col("embedding").cast("array<double>"), k * 8 + 1, F.lit(8)))
    pooled = ad.vectors(spark, sf_dir).select("entry_id", emb.mean_pool(tokens).alias("pooled"))
    return pooled.select("entry_id", F.round(F.get("pooled", F.lit(0)), 6).alias("first"), F.round(F.get("pooled", F.lit(7)), 6).alias("last"))


@query
def ml03_head_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way of every prediction: four fixed heads, standardised vectors, the best two labels of at least 0.3."""
    i = np.arange(64)
    coef = np.stack([((i * 7 + 3 * k) % 11 - 5) / 5 for k in range(4)], axis=1)
    head = ml.Heads("MF", -1, ("H0", "H1", "H2", "H3"), coef, np.array([0.25, -0.5, 0.0, 0.1]), i / 640, 1.0 + i % 3)
    best = ml.predict_top_k(ad.vectors(spark, sf_dir).select("entry_id", "embedding"), [head], top_k=2, min_score=0.3)
    return best.withColumn("score", F.round("score", 6))


@query
def ml06_cv_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold predictions of cross-validated heads (held to invariants by tests)."""
    vectors, folds, labels = ad.vectors(spark, sf_dir), _vector_folds(spark, sf_dir), _vector_labels(spark, sf_dir)
    pairs = feat.label_pairs(vectors, labels, feat.select_terms(labels, 2))
    return ml.cross_validate(vectors, folds, pairs, feat.trainable_terms(pairs, folds))[0]


def _group_vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders by a group of four as one-hot vectors, their folds, and labels of what they hold."""
    group = F.pmod(F.floor("o_totalprice"), F.lit(4))
    vector = F.array(*((group == k).cast("float") for k in range(4)))
    vectors = ad.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("entry_id"), vector.alias("embedding"))
    kind = F.pmod("l_partkey", F.lit(6))
    branch = F.get(F.array(F.lit("MF"), F.lit("BP"), F.lit("CC")), F.pmod(kind, F.lit(3)).cast("int"))
    labels = ad.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("entry_id"), branch.alias("branch"), F.concat(F.lit("K"), kind.cast("string")).alias("term")
    )
    return vectors, ad.folds_of_orders(spark, sf_dir), labels


@query
def ml06_one_hot_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold scores of heads fitted without a penalty on one-hot groups: there the optimum has a closed form."""
    vectors, folds, labels = _group_vectors(spark, sf_dir)
    pairs = feat.label_pairs(vectors, labels, feat.select_terms(labels, 2))
    scored, _ = ml.cross_validate(vectors, folds, pairs, feat.trainable_terms(pairs, folds), alpha=0.0, steps=100, tolerance=1e-9)
    return scored.withColumn("score", F.round("score", 4))


@query
def snk09_stored_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heads of two branches and two folds, stored, then read in the tasks that score each fold."""
    i = np.arange(64)
    heads = [
        ml.Heads(branch, fold, tuple(f"H{fold}{k}" for k in range(3)), np.stack([((i * (5 + b) + 3 * k + fold) % 11 - 5) / 5 for k in range(3)], axis=1), np.arange(3) / 4 - b, i / 640, 1.0 + i % 3)
        for b, branch in enumerate(("MF", "BP"))
        for fold in (0, 1)
    ]
    path = ml.store_heads(spark, heads, scratch_path(spark))
    placed = ad.vectors(spark, sf_dir).withColumn("fold", F.pmod(F.col("entry_id").cast("long"), F.lit(2)).cast("int"))
    return ml.predict_stored(placed, path, [0, 1], top_k=2, min_score=0.2).withColumn("score", F.round("score", 6))


QUERIES |= FILE_QUERIES
