"""Prediction tables: collapse, prune, calibrate, repair and blend.

Ids: PRJ-04, PRJ-18, AGG-06, AGG-07, AGG-12, AGG-13, WIN-02, WIN-05, DOM-07..12, SNK-07.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annofold.functions import clip_unit, strict_unit
from annofold.operators.metrics import score_branches
from annofold.schemas import BRANCHES, PREDICTION_COLUMNS, fail_if_any, require_columns
from annofold.storage import broadcast_if_small, dealt


def clip_scores(df: DataFrame, column: str = "score") -> DataFrame:
    """``column`` as a double in [0, 1]; text that is no number fails the query."""
    require_columns(df, (column,), "predictions")
    return df.withColumn(column, strict_unit(F.col(column)))


def _counted(predictions: DataFrame, rows: int | None) -> int:
    return predictions.count() if rows is None else rows


def collapse_scores(predictions: DataFrame, rows: int | None = None) -> DataFrame:
    """The best score of each (entry_id, term, branch), clipped; rows lacking a key or a score go.

    Dealt by entry to tasks by the number of rows, which is counted unless ``rows`` states it.
    """
    return _best(dealt(_keyed(predictions), _counted(predictions, rows), "entry_id"))


def _keyed(predictions: DataFrame) -> DataFrame:
    require_columns(predictions, PREDICTION_COLUMNS, "predictions")
    keys = [F.col(c).cast("string").alias(c) for c in PREDICTION_COLUMNS[:3]]
    return predictions.select(*keys, strict_unit(F.col("score")).alias("score")).na.drop()


def _best(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy(*PREDICTION_COLUMNS[:3]).agg(F.max("score").alias("score"))


def prune_top_k(predictions: DataFrame, top_k: int | None, by: Sequence[str] = ("entry_id", "branch")) -> DataFrame:
    """The ``top_k`` best rows of each group, ties by term; no limit for None or 0 and below.

    A row_number filter: each task keeps at most ``top_k`` rows of a group before the shuffle.
    """
    if not top_k or top_k <= 0:
        return predictions
    rest = sorted(set(predictions.columns) - {*by, "score", "term"})
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "term", *rest)
    return predictions.withColumn("__at", F.row_number().over(order)).filter(F.col("__at") <= top_k).drop("__at")


def normalize_by_branch(predictions: DataFrame, method: str = "max") -> DataFrame:
    """Scores divided by the branch's largest one (``max``) or as they are (``none``), clipped.

    A branch without a positive score is left alone. There are three branches, so their
    maxima come from an aggregation and a join with three rows, not from a window that would
    put a third of the table into one task.
    """
    if method not in ("max", "none"):
        raise ValueError(f"unknown normalization method: {method}")
    clipped = clip_scores(predictions)
    if method == "none":
        return clipped
    top = clipped.groupBy(F.col("branch").alias("top_branch")).agg(F.max("score").alias("top"))
    both = clipped.join(F.broadcast(top), F.col("branch") == F.col("top_branch"), "left")
    scaled = clip_unit(F.when(F.col("top") > 0, F.col("score") / F.col("top")).otherwise(F.col("score")))
    return both.withColumn("score", scaled).select(*predictions.columns)


def branch_stats(predictions: DataFrame) -> DataFrame:
    """raw_score_min, raw_score_max, raw_score_mean and prediction_rows of each branch."""
    return (
        clip_scores(predictions)
        .filter("branch IS NOT NULL")
        .groupBy("branch")
        .agg(
            F.min("score").alias("raw_score_min"),
            F.max("score").alias("raw_score_max"),
            F.avg("score").alias("raw_score_mean"),
            F.count(F.lit(1)).alias("prediction_rows"),
        )
    )


def fit_calibration(
    oof: DataFrame, truth: DataFrame, method: str = "max", average: str = "protein_macro", step: float = 0.01
) -> DataFrame:
    """One row per branch: its Fmax, its score statistics and the scale to divide by.

    ``max`` scales by the branch's largest score, ``none`` by 1; a branch without predictions
    or without a positive score has the scale 1.
    """
    if method not in ("max", "none"):
        raise ValueError(f"unknown calibration method: {method}")
    scores = score_branches(truth, oof, step=step, average=average)
    joined = scores.join(F.broadcast(branch_stats(oof)), "branch", "left")
    top = F.when(F.col("raw_score_max") > 0, F.col("raw_score_max")).otherwise(1.0) if method == "max" else F.lit(1.0)
    return joined.withColumn("method", F.lit(method)).withColumn("scale", F.coalesce(top, F.lit(1.0)))


def apply_calibration(predictions: DataFrame, calibration: DataFrame, validate: bool = True) -> DataFrame:
    """Clipped scores divided by their branch's scale and clipped again.

    ``calibration`` (branch, method, scale) has a row for each of the three branches at most.
    ``validate`` fails at once on a branch or a method that it does not know.
    """
    require_columns(calibration, ("branch", "method", "scale"), "calibration")
    clipped = clip_scores(predictions)
    table = calibration.select(F.col("branch").alias("cal_branch"), "method", "scale").limit(len(BRANCHES))
    if validate:
        fail_if_any(calibration.filter(~F.col("method").isin("max", "none")), "unknown calibration method", "method")
        strange = clipped.join(F.broadcast(table), F.col("branch") == F.col("cal_branch"), "left_anti")
        fail_if_any(strange, "branches without calibration", "branch")
    both = clipped.join(F.broadcast(table), F.col("branch") == F.col("cal_branch"))
    scaled = F.when((F.col("method") == "max") & (F.col("scale") > 0), F.col("score") / F.col("scale")).otherwise(F.col("score"))
    return both.withColumn("score", clip_unit(scaled)).select(*predictions.columns)


def _terms(terms: DataFrame) -> DataFrame:
    require_columns(terms, ("term", "branch"), "terms")
    return terms.select(F.col("term").cast("string").alias("term"), F.col("branch").alias("term_branch")).dropDuplicates(["term"])


def _usable(predictions: DataFrame) -> DataFrame:
    require_columns(predictions, ("entry_id", "term", "score"), "predictions")
    chosen = predictions.select(
        F.col("entry_id").cast("string").alias("entry_id"),
        F.col("term").cast("string").alias("term"),
        strict_unit(F.col("score")).alias("score"),
    )
    return chosen.filter("entry_id IS NOT NULL AND term IS NOT NULL")


def canonical_predictions(predictions: DataFrame, terms: DataFrame, rows: int | None = None) -> DataFrame:
    """Predictions of known terms under the term's own branch, collapsed to the best score."""
    given = dealt(_usable(predictions), _counted(predictions, rows), "entry_id")
    named = given.join(broadcast_if_small(_terms(terms)), "term")
    return _best(_keyed(named.select("entry_id", "term", F.col("term_branch").alias("branch"), "score")))


def repair_hierarchy(predictions: DataFrame, ancestors: DataFrame, terms: DataFrame, rows: int | None = None) -> DataFrame:
    """Every ancestor of a predicted term scores at least as much as the term.

    ``ancestors`` (term, ancestor, ancestor_branch). Rows are dealt by entry, to tasks by their number
    (counted unless ``rows`` states it). A term's best score meets the term and its ancestors in
    one join, whose rows are combined where they are made.
    """
    known = _terms(terms)
    own = known.select(F.col("term").alias("child"), F.col("term").alias("closed"), F.col("term_branch").alias("branch"))
    up = ancestors.select(F.col("term").alias("child"), F.col("ancestor").cast("string").alias("closed"), F.col("ancestor_branch").alias("branch"))
    # Ancestors of known terms only; the table has as many rows as the ontology.
    lifts = broadcast_if_small(own.unionByName(up.join(known.select(F.col("term").alias("child")), "child", "left_semi")).distinct())
    base = dealt(_usable(predictions), _counted(predictions, rows), "entry_id").groupBy("entry_id", "term").agg(F.max("score").alias("score"))
    lifted = base.join(lifts, F.col("term") == F.col("child")).select("entry_id", F.col("closed").alias("term"), "branch", "score")
    return _best(_keyed(lifted))


def repair_by_branch(
    predictions: DataFrame, ancestors: DataFrame, terms: DataFrame, top_k: int | None = 100
) -> DataFrame:
    """Hierarchy repair inside each branch, then the best ``top_k`` per entry and branch.

    Predictions under another branch than their term's go. One plan for all branches.
    """
    stated = predictions.join(
        broadcast_if_small(_terms(terms).withColumnRenamed("term", "known")),
        (F.col("term") == F.col("known")) & (F.col("branch") == F.col("term_branch")),
        "left_semi",
    )
    inside = ancestors.filter("term_branch = ancestor_branch")
    return prune_top_k(repair_hierarchy(stated, inside, terms, predictions.count()), top_k)


def blend_mean(frames: Sequence[DataFrame], terms: DataFrame, weights: Sequence[float] | None = None) -> DataFrame:
    """Weighted mean of several prediction tables; a table without the key counts as score 0."""
    if not frames:
        raise ValueError("there is nothing to blend")
    weights = [1.0] * len(frames) if weights is None else list(weights)
    if len(weights) != len(frames):
        raise ValueError("weights and tables differ in number")
    if any(w < 0 for w in weights) or sum(weights) <= 0:
        raise ValueError("weights must not be negative, nor all 0")
    parts = [_usable(df).filter("score IS NOT NULL").withColumn("source", F.lit(k)) for k, df in enumerate(frames)]
    # One shuffle for all tables; the best score of each, then their sum in the order of the tables.
    given = dealt(reduce(DataFrame.unionByName, parts), sum(df.count() for df in frames), "entry_id")
    named = given.join(broadcast_if_small(_terms(terms)), "term").filter("term_branch IS NOT NULL")
    best = named.groupBy("entry_id", "term", F.col("term_branch").cast("string").alias("branch")).agg(
        *(F.max(F.when(F.col("source") == k, F.col("score"))).alias(f"best_{k}") for k in range(len(frames)))
    )
    summed = reduce(Column.__add__, (F.coalesce(F.col(f"best_{k}"), F.lit(0.0)) * float(w) for k, w in enumerate(weights)))
    return best.select("entry_id", "term", "branch", clip_unit(summed / float(sum(weights))).alias("score"))


def scaled_source(predictions: DataFrame, scale: float = 1.0, top_k: int | None = None) -> DataFrame:
    """One side of a max blend: clipped, cut to ``top_k`` per entry and branch, then scaled."""
    require_columns(predictions, PREDICTION_COLUMNS, "predictions")
    if scale < 0:
        raise ValueError("the scale must not be negative")
    best = prune_top_k(clip_scores(predictions.select(*PREDICTION_COLUMNS)), top_k)
    return best.withColumn("score", clip_unit(F.col("score") * float(scale)))


def blend_max(
    homology: DataFrame,
    supervised: DataFrame,
    homology_scale: float = 1.0,
    supervised_scale: float = 0.05,
    supervised_top_k: int | None = 25,
) -> DataFrame:
    """The larger one of two scaled scores per key."""
    left = scaled_source(homology, homology_scale)
    right = scaled_source(supervised, supervised_scale, supervised_top_k)
    return collapse_scores(left.unionByName(right), homology.count() + supervised.count())
