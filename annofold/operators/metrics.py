"""Fmax by branch in one pass over the predictions.

Ids: PRJ-05, PRJ-07, PRJ-08, PRJ-16, DOM-13..16, WIN-08, AGG-19, JOI-19.

A score counts at every threshold up to it, so an entry's precision and recall change only
where its scores lie. Each (branch, entry) yields its changes at those thresholds; summed by
(branch, threshold) they are at most 3 x 101 rows, and running sums over these give the means
at every threshold. Nothing is multiplied by the number of thresholds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annofold.functions import number, thresholds
from annofold.schemas import BRANCHES, fail_if_any, not_missing, require_columns, with_branch

AVERAGES = ("protein_macro", "micro")
#: Places to which F is rounded before thresholds are compared: sums come in any order.
F_PLACES = 12


def prepare_truth(truth: DataFrame) -> DataFrame:
    """Distinct (entry_id, term, branch) of the three branches; an unknown aspect fails."""
    require_columns(truth, ("entry_id", "term"), "truth")
    out = with_branch(truth, "truth").select(
        F.col("entry_id").cast("string").alias("entry_id"), F.col("term").cast("string").alias("term"), "branch"
    )
    return out.filter(not_missing("entry_id", "term")).filter(F.col("branch").isin(*BRANCHES)).dropDuplicates()


def prepare_predictions(predictions: DataFrame, terms: DataFrame | None = None, validate: bool = True) -> DataFrame:
    """The best score of each (entry_id, term, branch) of the three branches.

    The branch comes from the table, from its aspect, or from ``terms`` (term, branch); rows
    without one go. ``validate`` fails at once on a score outside [0, 1].
    """
    require_columns(predictions, ("entry_id", "term", "score"), "predictions")
    if "branch" in predictions.columns or "aspect" in predictions.columns:
        named = with_branch(predictions, "predictions", strict=False)
    elif terms is not None:
        known = terms.select(F.col("term").cast("string").alias("known_term"), "branch").dropDuplicates(["known_term"])
        named = predictions.join(known, F.col("term").cast("string") == F.col("known_term"), "left")
    else:
        raise ValueError("predictions need a branch or an aspect column, or a table of terms")
    chosen = named.select(
        F.col("entry_id").cast("string").alias("entry_id"),
        F.col("term").cast("string").alias("term"),
        "branch",
        number(F.col("score").cast("double")).alias("score"),
    )
    chosen = chosen.na.drop().filter(F.col("branch").isin(*BRANCHES))
    if validate:
        fail_if_any(chosen.filter("score < 0 OR score > 1"), "scores outside [0, 1]", "score")
    return chosen.groupBy("entry_id", "term", "branch").agg(F.max("score").alias("score"))


def _bucket(score: Column, taus: list[float]) -> Column:
    """Index of the largest threshold that ``score`` reaches, compared with the thresholds themselves.

    The product is only a first guess, off by one at most: 0.29 * 100 is below 29.
    """
    n = len(taus) - 1
    table = F.array(*(F.lit(t) for t in taus))
    guess = F.floor(score * n).cast("int")
    up = F.when((guess < n) & (F.get(table, guess + 1) <= score), guess + 1)
    down = F.when(F.get(table, guess) > score, guess - 1)
    return F.coalesce(up, down, guess)


def _changes(truth: DataFrame, predictions: DataFrame, taus: list[float]) -> DataFrame:
    """(branch, entry_id, b, n, tp, n_true): what an entry's predictions at threshold b add; b is -1 for truth alone."""
    both = predictions.withColumn("truth", F.lit(0)).unionByName(
        truth.withColumn("score", F.lit(None).cast("double")).withColumn("truth", F.lit(1))
    )
    merged = both.groupBy("branch", "entry_id", "term").agg(F.max("score").alias("score"), F.max("truth").alias("truth"))
    return (
        merged.withColumn("b", F.coalesce(_bucket(F.col("score"), taus), F.lit(-1)))
        .groupBy("branch", "entry_id", "b")
        .agg(
            F.count("score").alias("n"),
            F.coalesce(F.sum(F.when(F.col("score").isNotNull(), F.col("truth"))), F.lit(0)).alias("tp"),
            F.sum("truth").alias("n_true"),
        )
    )


def threshold_curve(truth: DataFrame, predictions: DataFrame, step: float = 0.01, average: str = "protein_macro") -> DataFrame:
    """(branch, threshold, precision, recall, f) of every branch at every threshold.

    ``truth`` and ``predictions`` as prepared. Macro: precision is the mean over entries with a
    prediction at the threshold, recall the mean over all entries with truth. Micro: pairs
    of entry and term are counted over the branch.
    """
    if average not in AVERAGES:
        raise ValueError(f"unknown average: {average}")
    taus = thresholds(step)
    changes = _changes(truth, predictions, taus)
    if average == "protein_macro":
        entry = Window.partitionBy("branch", "entry_id")
        down = entry.orderBy(F.desc("b"))
        seen = down.rowsBetween(Window.unboundedPreceding, 0)
        held = (
            changes.withColumn("all_true", F.sum("n_true").over(entry))
            .withColumn("precision", F.when(F.col("b") >= 0, F.sum("tp").over(seen) / F.sum("n").over(seen)))
            .withColumn("before", F.lag("precision").over(down))
        )
        summed = held.groupBy("branch", "b").agg(
            F.sum(F.col("precision") - F.coalesce("before", F.lit(0.0))).alias("precision"),
            F.sum(F.when(F.col("before").isNull() & (F.col("b") >= 0), 1).otherwise(0)).alias("predicted"),
            F.sum(F.when(F.col("tp") > 0, F.col("tp") / F.col("all_true")).otherwise(0.0)).alias("recall"),
        )
        # Entries with truth, where each is counted once: its n_true over its sum is 1.
        wanted = truth.groupBy("branch").agg(F.count_distinct("entry_id").cast("double").alias("wanted"))
    else:
        summed = changes.groupBy("branch", "b").agg(
            F.sum("tp").cast("double").alias("precision"), F.sum("n").alias("predicted"), F.sum("tp").cast("double").alias("recall")
        )
        wanted = truth.groupBy("branch").agg(F.count(F.lit(1)).cast("double").alias("wanted"))
    spark = truth.sparkSession
    grid = spark.createDataFrame([(b, k, t) for b in BRANCHES for k, t in enumerate(taus)], "branch string, b int, threshold double")
    # At most 3 x (1 / step + 2) rows from here on.
    whole = grid.join(summed, ["branch", "b"], "left")
    over = Window.partitionBy("branch").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, 0)
    run = whole.select(
        "branch",
        "b",
        "threshold",
        *(F.sum(F.coalesce(c, F.lit(0))).over(over).alias(c) for c in ("precision", "predicted", "recall")),
    ).join(F.broadcast(wanted), "branch", "left")
    share = lambda a, b: F.when(F.col(b) > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(a) / F.col(b)))).otherwise(0.0)
    rated = run.select("branch", "b", "threshold", share("precision", "predicted").alias("precision"), share("recall", "wanted").alias("recall"))
    both = F.col("precision") + F.col("recall")
    return rated.withColumn("f", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0))


def score_branches(
    truth: DataFrame,
    predictions: DataFrame,
    terms: DataFrame | None = None,
    step: float = 0.01,
    average: str = "protein_macro",
    validate: bool = True,
) -> DataFrame:
    """Three rows, one for each branch: fmax at the first best threshold, and mean_fmax over all three.

    A branch without truth or predictions scores 0 at threshold 0.
    """
    true = prepare_truth(truth)
    given = prepare_predictions(predictions, terms, validate)
    curve = threshold_curve(true, given, step, average)
    # max_by on (F, -b): the largest F, and of equal ones the first threshold.
    key = F.struct(F.round("f", F_PLACES).alias("f"), -F.col("b"))
    best = curve.groupBy("branch").agg(F.max_by(F.struct("threshold", "precision", "recall", "f"), key).alias("best"))
    of_truth = true.groupBy("branch").agg(
        F.count_distinct("entry_id").alias("n_truth_entries"), F.count_distinct("term").alias("n_truth_terms")
    )
    of_given = given.groupBy("branch").agg(F.count(F.lit(1)).alias("n_prediction_rows"))
    zero = F.col("best.f") <= 0
    rows = (
        best.join(F.broadcast(of_truth), "branch", "left")
        .join(F.broadcast(of_given), "branch", "left")
        .select(
            "branch",
            F.col("best.f").alias("fmax"),
            F.col("best.threshold").alias("threshold"),
            F.when(zero, 0.0).otherwise(F.col("best.precision")).alias("precision"),
            F.when(zero, 0.0).otherwise(F.col("best.recall")).alias("recall"),
            *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_truth_entries", "n_truth_terms", "n_prediction_rows")),
        )
    )
    # Three rows: an unpartitioned window over them is a constant amount of work.
    return rows.withColumn("mean_fmax", F.avg("fmax").over(Window.partitionBy(F.lit(1)))).withColumn("average", F.lit(average))


def score_branch(
    truth: DataFrame,
    predictions: DataFrame,
    branch: str,
    step: float = 0.01,
    average: str = "protein_macro",
) -> DataFrame:
    """The row of one branch, without the mean over branches."""
    if branch not in BRANCHES:
        raise ValueError(f"unknown branch: {branch}")
    return score_branches(truth, predictions, step=step, average=average).filter(F.col("branch") == branch).drop("mean_fmax")
