"""Rows are dealt by entry to as many tasks as their number asks for, whatever AQE would merge."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from annofold import storage
from annofold.operators import ontology as onto
from annofold.operators import predictions as pred
from annofold.operators import submission as sub


def tables(spark):
    rows = spark.range(400).select(F.concat(F.lit("e"), F.col("id") % 100).alias("entry_id"), F.concat(F.lit("T"), F.col("id") % 3).alias("term"), F.lit("MF").alias("branch"), (F.col("id") / 400).alias("score"))
    terms = spark.createDataFrame([(f"T{k}", "MF") for k in range(3)], "term string, branch string")
    up = spark.createDataFrame([("T1", "T0", 1, "MF", "MF")], "term string, ancestor string, distance int, term_branch string, ancestor_branch string")
    return rows, terms, up, spark.createDataFrame([], "alt_id string, term string")


CASES = {
    "repair": lambda p, t, up, alt: pred.repair_hierarchy(p, up, t),
    "repair_topk": lambda p, t, up, alt: pred.repair_by_branch(p, up, t, 2),
    "blend": lambda p, t, up, alt: pred.blend_mean([p, p], t),
    "canonical": lambda p, t, up, alt: pred.canonical_predictions(p, t),
    "collapse": lambda p, t, up, alt: pred.collapse_scores(p),
    "closure": lambda p, t, up, alt: onto.close_labels(p, t, up, alt),
    "submission": lambda p, t, up, alt: sub.shape_submission(p, p, t, 2, 2),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_tasks_grow_with_rows(spark, monkeypatch, case):
    monkeypatch.setattr(storage, "TASK_ROWS", 20)
    got = CASES[case](*tables(spark)).withColumn("task", F.spark_partition_id())
    placed = got.groupBy("task").agg(F.countDistinct("entry_id").alias("entries")).collect()
    assert len(placed) > 10 and sum(r["entries"] for r in placed) == 100


def test_validation_counts_entries_once(spark):
    given = spark.createDataFrame([("a", "T0", 0.5), ("a", "T1", 0.5), ("a", "T1", 2.0), ("b", "T9", 0.5), (None, "T0", 0.5), (None, "T1", 0.1)], "entry_id string, term string, score double")
    entries = spark.createDataFrame([("a",), ("c",)], "entry_id string")
    terms = spark.createDataFrame([("T0",), ("T1",)], "term string")
    got = sub.validate_submission(given, entries, terms).first().asDict()
    assert (got["unique_entry_ids"], got["covered_test_entry_count"], got["unique_terms"], got["prediction_rows"]) == (2, 1, 3, 6)
    assert (got["duplicate_entry_term_count"], got["invalid_score_count"], got["invalid_entry_count"], got["invalid_term_count"]) == (1, 1, 3, 1)
