"""Submission tables: shape and validate.

Ids: DOM-17, AGG-18, WIN-03, JOI-17, JOI-18.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annofold.functions import number, strict_unit
from annofold.operators.predictions import prune_top_k
from annofold.schemas import SUBMISSION_COLUMNS, require_columns
from annofold.storage import broadcast_if_small, dealt


def _ids(table: DataFrame, column: str) -> DataFrame:
    return table.select(F.col(column).cast("string").alias(column)).filter(f"{column} IS NOT NULL").distinct()


def shape_submission(
    predictions: DataFrame,
    entries: DataFrame,
    terms: DataFrame,
    top_k_per_branch: int | None = 100,
    top_k_total: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """(entry_id, term, score) for a submission.

    In this order: the best ``top_k_per_branch`` per entry and branch (rows that go later
    still use up their place), clipping, only ``entries`` (entry_id) and ``terms`` (term), the
    best score per pair, and the best ``top_k_total`` per entry. All that happens where rows are
    dealt by entry, to tasks by their number, which is counted unless ``rows`` states it.
    """
    require_columns(predictions, SUBMISSION_COLUMNS, "predictions")
    if top_k_per_branch and top_k_per_branch > 0:
        require_columns(predictions, ("branch",), "predictions")
    chosen = predictions.withColumn("entry_id", F.col("entry_id").cast("string")).withColumn("term", F.col("term").cast("string"))
    placed = dealt(chosen.withColumn("score", strict_unit(F.col("score"))), predictions.count() if rows is None else rows, "entry_id")
    best = prune_top_k(placed, top_k_per_branch)
    valid = (
        best.select(*SUBMISSION_COLUMNS)
        .na.drop()
        .join(_ids(entries, "entry_id"), "entry_id", "left_semi")
        .join(broadcast_if_small(_ids(terms, "term")), "term", "left_semi")
    )
    pairs = valid.groupBy("entry_id", "term").agg(F.max("score").alias("score"))
    return prune_top_k(pairs, top_k_total, by=("entry_id",))


def validate_submission(
    submission: DataFrame, entries: DataFrame, terms: DataFrame, require_all_entries: bool = False
) -> DataFrame:
    """One row of counts and ``valid``.

    A score must be a number in [0, 1], a pair must occur once, entries and terms must be
    known, and with ``require_all_entries`` every entry must be there.
    """
    require_columns(submission, SUBMISSION_COLUMNS, "submission")
    rows = submission.select(
        F.col("entry_id").cast("string").alias("entry_id"),
        F.col("term").cast("string").alias("term"),
        number(F.col("score")).alias("score"),
    )
    known_entry = _ids(entries, "entry_id").withColumn("entry_known", F.lit(True))
    known_term = _ids(terms, "term").withColumn("term_known", F.lit(True))
    bad_score = F.col("score").isNull() | (F.col("score") < 0) | (F.col("score") > 1)
    # Rows are dealt by entry, one row per pair is made there, and an entry's first pair counts the
    # entry, so that no row is copied for a distinct count of entries.
    pairs = dealt(rows, submission.count(), "entry_id").groupBy("entry_id", "term").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(bad_score, 1).otherwise(0)).alias("bad")
    )
    at = F.row_number().over(Window.partitionBy("entry_id").orderBy("term"))
    marked = pairs.withColumn("first", (at == 1) & F.col("entry_id").isNotNull())
    marked = marked.join(known_entry, "entry_id", "left").join(broadcast_if_small(known_term), "term", "left")
    counts = marked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("prediction_rows"),
        F.count_if("first").alias("unique_entry_ids"),
        F.count_distinct("term").alias("unique_terms"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_entry_term_count"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_score_count"),
        F.coalesce(F.sum(F.when(F.col("entry_known").isNull(), F.col("n"))), F.lit(0)).alias("invalid_entry_count"),
        F.coalesce(F.sum(F.when(F.col("term_known").isNull(), F.col("n"))), F.lit(0)).alias("invalid_term_count"),
        F.count_if(F.col("first") & F.col("entry_known")).alias("covered_test_entry_count"),
    )
    total = known_entry.agg(F.count(F.lit(1)).alias("test_entry_count"))
    both = counts.withColumn("__one", F.lit(1)).join(total.withColumn("__one", F.lit(1)), "__one").drop("__one")
    missing = F.col("test_entry_count") - F.col("covered_test_entry_count")
    faults = [F.col(c) == 0 for c in ("duplicate_entry_term_count", "invalid_score_count", "invalid_entry_count", "invalid_term_count")]
    valid = F.col("prediction_rows") > 0
    for clean in faults:
        valid = valid & clean
    if require_all_entries:
        valid = valid & (missing == 0)
    return both.withColumn("missing_test_entry_count", missing).withColumn("valid", valid)


def missing_entries(submission: DataFrame, entries: DataFrame) -> DataFrame:
    """(entry_id) of ``entries`` without a row in ``submission``."""
    there = _ids(submission, "entry_id")
    return _ids(entries, "entry_id").join(there, "entry_id", "left_anti")


