"""Vectors and labels for the supervised heads.

Ids: JOI-20, JOI-21, AGG-10, AGG-11, ML-05, WIN-07, SRC-15 (assembly).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annofold.operators.embeddings import check_manifest
from annofold.schemas import fail_if_any, not_missing, require_columns

# Default number of labels of each branch, and entries that a label needs.
MAX_LABELS = {"MF": 1500, "BP": 2500, "CC": 1000}
MIN_COUNT = 25


def assemble_embeddings(manifest: DataFrame, vectors: DataFrame, validate: bool = True) -> DataFrame:
    """(entry_id, row_index, embedding) of a complete manifest.

    ``vectors`` (shard_path, position, embedding) as read from shard files. ``validate`` fails
    at once on an incomplete manifest, a row without a vector, a shard with other rows than
    its manifest has, or vectors of several lengths.
    """
    if validate:
        check_manifest(manifest)
    of_shard = vectors.select(F.col("shard_path").alias("v_path"), F.col("position").alias("v_at"), "embedding")
    joined = manifest.join(
        of_shard, (F.col("shard_path") == F.col("v_path")) & (F.col("row_index_in_batch") == F.col("v_at")), "left"
    )
    if validate:
        fail_if_any(joined.filter("v_path IS NULL"), "entries without a vector", "entry_id")
        wanted = manifest.groupBy("shard_path").agg(F.count(F.lit(1)).alias("wanted"))
        there = of_shard.groupBy(F.col("v_path").alias("shard_path")).agg(F.count(F.lit(1)).alias("there"))
        fail_if_any(wanted.join(there, "shard_path").filter("wanted != there"), "shards with another number of rows", "shard_path")
        widths = of_shard.agg(F.min(F.size("embedding")).alias("a"), F.max(F.size("embedding")).alias("b"))
        fail_if_any(widths.filter("a != b"), "vectors differ in length", "b")
    return joined.select("entry_id", "row_index", "embedding")


def align(entries: DataFrame, wanted: DataFrame, validate: bool = True) -> DataFrame:
    """Rows of ``entries`` for each of ``wanted`` (entry_id); ``validate`` fails on a missing one."""
    keys = wanted.select(F.col("entry_id").cast("string").alias("entry_id"))
    if validate:
        fail_if_any(keys.join(entries, "entry_id", "left_anti"), "entries without vectors", "entry_id")
    return keys.join(entries, "entry_id")


def select_terms(
    labels: DataFrame, min_count: int = MIN_COUNT, max_labels: dict[str, int] | int | None = None
) -> DataFrame:
    """(branch, term, n_proteins): labels of at least ``min_count`` entries, the commonest ``max_labels`` of each branch."""
    require_columns(labels, ("entry_id", "term", "branch"), "labels")
    counted = (
        labels.filter(not_missing("entry_id", "term", "branch"))
        .groupBy("branch", "term")
        .agg(F.count_distinct("entry_id").alias("n_proteins"))
        .filter(F.col("n_proteins") >= min_count)
    )
    if not max_labels:
        return counted
    order = Window.partitionBy("branch").orderBy(F.desc("n_proteins"), "term")
    ranked = counted.withColumn("__at", F.row_number().over(order))
    if isinstance(max_labels, int):
        return ranked.filter(F.col("__at") <= max_labels).drop("__at")
    bound = F.lit(None).cast("int")
    for branch, most in max_labels.items():
        if most > 0:
            bound = F.when(F.col("branch") == branch, most).otherwise(bound)
    return ranked.filter(bound.isNull() | (F.col("__at") <= bound)).drop("__at")


def label_pairs(entries: DataFrame, labels: DataFrame, selected: DataFrame) -> DataFrame:
    """Distinct positives (entry_id, branch, term) of known entries and selected terms."""
    ids = entries.select(F.col("entry_id").cast("string").alias("entry_id")).distinct()
    known = labels.select(F.col("entry_id").cast("string").alias("entry_id"), "branch", "term").distinct()
    return known.join(selected.select("branch", "term").distinct(), ["branch", "term"], "left_semi").join(ids, "entry_id", "left_semi")


def trainable_terms(pairs: DataFrame, folds: DataFrame, min_positive: int = 1) -> DataFrame:
    """(branch, term, held_fold, n_pos, n_rows) of labels that can be fitted without fold ``held_fold``.

    A label needs ``min_positive`` positives and one negative among the rows of the other
    folds; ``held_fold`` -1 stands for a fit on all rows. Counts by (label, fold) are combined
    first, so each label costs its folds, not its entries, in the join with folds.
    """
    fold_of = folds.select(F.col("entry_id").cast("string").alias("entry_id"), F.col("fold").cast("int").alias("fold"))
    rows = fold_of.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))
    held = rows.select(F.col("fold").alias("held_fold")).union(folds.sparkSession.createDataFrame([(-1,)], "held_fold int"))
    apart = F.col("fold") != F.col("held_fold")
    # Folds are a handful: (folds + 1) rows against (folds) and (labels x folds).
    n_rows = held.join(F.broadcast(rows), apart).groupBy("held_fold").agg(F.sum("rows").alias("n_rows"))
    per_fold = pairs.join(fold_of, "entry_id").groupBy("branch", "term", "fold").agg(F.count(F.lit(1)).alias("pos"))
    counted = per_fold.join(F.broadcast(held), apart).groupBy("branch", "term", "held_fold").agg(F.sum("pos").alias("n_pos"))
    both = counted.join(F.broadcast(n_rows), "held_fold")
    return both.filter((F.col("n_pos") >= min_positive) & (F.col("n_pos") < F.col("n_rows"))).select(
        "branch", "term", "held_fold", "n_pos", "n_rows"
    )


def top_k_of_vectors(
    scores: DataFrame, terms: list[str], branch: str, top_k: int | None = 100, min_score: float = 0.0
) -> DataFrame:
    """(entry_id, term, branch, score): the ``top_k`` best labels of each row of ``scores`` (entry_id, scores array).

    Ties go to the earlier label; scores below ``min_score`` go afterwards. Sorted inside
    the row, without a shuffle.
    """
    names = F.array(*(F.lit(t) for t in terms)) if terms else F.array().cast("array<string>")
    placed = F.transform("scores", lambda s, i: F.struct((-s.cast("double")).alias("order"), i.alias("at")))
    sorted_ = F.array_sort(placed)
    best = F.slice(sorted_, 1, top_k) if top_k and top_k > 0 else sorted_
    return (
        scores.select(F.col("entry_id").cast("string").alias("entry_id"), F.explode(best).alias("hit"))
        .select(
            "entry_id", F.get(names, F.col("hit.at")).alias("term"), F.lit(branch).alias("branch"), (-F.col("hit.order")).alias("score")
        )
        .filter(F.col("score") >= min_score)
    )
