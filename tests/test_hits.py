from __future__ import annotations

import math
from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from annofold.operators import hits as h

HITS = "qseqid string, sseqid string, bitscore double, qcov double, tcov double"


def weights(df):
    return {(r["query_id"], r["target_id"]): round(r["hit_weight"], 9) for r in df.collect()}


def test_bitscores_per_query(spark):
    df = spark.createDataFrame([("q", "a", 100.0, 1.0, 100.0), ("q", "b", 25.0, 1.0, 1.0), ("z", "a", 0.0, 1.0, 1.0), (None, "a", 9.0, 1.0, 1.0)], HITS)
    assert weights(h.add_hit_weights(df)) == {("q", "a"): 1.0, ("q", "b"): 0.25}


@pytest.mark.parametrize(
    ("column", "values", "want"),
    [
        ("pident", ["90", "0.5", "150", "junk"], {"t0": 0.9, "t1": 0.5, "t2": 1.0}),
        ("evalue", ["1e-100", "0", "1", "nan"], {"t0": 0.5, "t1": 1.0}),
        ("weight", ["0.3", "7", None, "-1"], {"t0": 0.3, "t1": 1.0}),
    ],
)
def test_other_bases(spark, column, values, want):
    df = spark.createDataFrame([("q", f"t{k}", v) for k, v in enumerate(values)], f"query string, target string, {column} string")
    assert {t: w for (_, t), w in weights(h.add_hit_weights(df)).items()} == want


def test_no_basis_and_coverage(spark):
    df = spark.createDataFrame([("q", "a", "25", "100"), ("q", "a", "25", "100"), ("q", "b", None, None)], "query string, target string, qcov string, scov string")
    assert weights(h.add_hit_weights(df)) == {("q", "a"): 0.5, ("q", "b"): 1.0}


def test_one_score_decides_for_the_table(spark):
    df = spark.createDataFrame([("q", "a", 0.5, 90.0), ("q", "b", None, 80.0)], "query string, target string, score double, bits double")
    assert weights(h.add_hit_weights(df)) == {("q", "a"): 0.5}


def test_missing_target(spark):
    with pytest.raises(ValueError, match="target_id"):
        h.normalize_hits(spark.createDataFrame([("q",)], "query string"))


def test_folds_and_self_hits(spark, rows):
    df = spark.createDataFrame([("a", "a", 100.0, 1.0, 1.0), ("a", "b", 50.0, 1.0, 1.0), ("a", "c", 40.0, 1.0, 1.0), ("a", "x", 30.0, 1.0, 1.0)], HITS)
    folds = spark.createDataFrame([("a", 0), ("b", 1), ("c", 0)], "entry_id string, fold int")
    kept = h.filter_oof_hits(df, folds)
    # The hit on itself sets the best bit score before it goes.
    assert rows(kept, "query_id", "target_id", "hit_weight", "query_fold", "target_fold") == [("a", "b", 0.5, 0, 1)]
    with pytest.raises(ValueError, match="fold"):
        h.filter_oof_hits(df, folds.drop("fold"))
    labels = spark.createDataFrame([("a", "T", "MF"), ("b", "T", "MF")], "entry_id string, term string, branch string")
    assert set(weights(h.filter_test_hits(df, labels))) == {("a", "b")}
    assert set(weights(h.filter_test_hits(df, labels, exclude_self=False))) == {("a", "a"), ("a", "b")}


def test_noisy_or(spark, rows):
    labels = spark.createDataFrame([("a", "T", "MF"), ("b", "T", "MF"), ("b", "U", "CC"), ("b", "V", None)], "entry_id string, term string, branch string")
    weighted = spark.createDataFrame([("q", "a", 0.5), ("q", "b", 0.5), ("r", "a", 1.0), ("s", "a", 0.5), ("s", "a", 0.2)], "query_id string, target_id string, hit_weight double")
    got = {(r["entry_id"], r["term"]): (round(r["score"], 12), r["n_hits"], r["best_hit_weight"]) for r in h.aggregate_hit_labels(weighted, labels).collect()}
    assert got == {("q", "T"): (0.75, 2, 0.5), ("q", "U"): (0.5, 1, 0.5), ("r", "T"): (1 - 1e-12, 1, 1.0), ("s", "T"): (0.6, 1, 0.5)}
    one = h.aggregate_hit_labels(weighted.filter("query_id = 'q'"), labels, max_hits=1)
    assert rows(one, "term") == [("T",)]
    assert h.aggregate_hit_labels(weighted, labels, min_weight=0.5).select("entry_id").distinct().collect()[0][0] == "r"
    assert h.aggregate_hit_labels(weighted.limit(0), labels).count() == 0
    summary = h.transfer_summary(weighted, h.aggregate_hit_labels(weighted, labels)).first().asDict()
    assert (summary["hit_rows"], summary["query_count"], summary["prediction_rows"], summary["prediction_rows_cc"]) == (5, 3, 4, 1)


def test_noisy_or_grows_with_hits(spark):
    labels = spark.createDataFrame([("a", "T", "MF"), ("b", "T", "MF")], "entry_id string, term string, branch string")
    score = []
    for hits in ([("q", "a", 0.3)], [("q", "a", 0.3), ("q", "b", 0.1)]):
        df = spark.createDataFrame(hits, "query_id string, target_id string, hit_weight double")
        score.append(h.aggregate_hit_labels(df, labels).first()["score"])
    assert score[0] < score[1] and math.isclose(score[1], 1 - 0.7 * 0.9)


def test_limits(spark):
    df = spark.createDataFrame([("q", t, w) for t, w in [("b", 0.5), ("a", 0.5), ("c", 0.9)]], "query_id string, target_id string, hit_weight double")
    assert {r["target_id"] for r in h.limit_hits(df, 2).collect()} == {"c", "a"}
    assert h.limit_hits(df, None).count() == h.limit_hits(df, 0).count() == 3


def test_an_entry_of_two_folds_meets_no_target_of_its_first(spark, rows):
    folds = spark.createDataFrame([("A", 0), ("A", 1), ("B", 1), ("C", 0)], "entry_id string, fold int")
    hits = spark.createDataFrame([("A", "B", 50.0), ("A", "C", 50.0)], "query_id string, target_id string, bitscore double")
    kept = h.filter_oof_hits(hits, folds)
    assert rows(kept, "query_id", "target_id", "query_fold", "target_fold") == [("A", "B", 0, 1)]


def test_scores_do_not_depend_on_the_order_of_hits(spark):
    """Labels of the same hits tie exactly, so the best of them is the first by term."""
    weights_of = [((i * 7919) % 1000 + 0.5) / 1003 for i in range(40 * 15)]
    some = [(f"q{i % 40}", f"t{i // 40}", w) for i, w in enumerate(weights_of)]
    labels = spark.createDataFrame([(f"t{k}", t, "MF") for k in range(15) for t in ("T", "U")], "entry_id string, term string, branch string")
    schema = "query_id string, target_id string, hit_weight double"
    seen = []
    for given, limit, cell_rows in ((some, 100, 5), (some[::-1], None, 1_000), (sorted(some, key=lambda r: r[2]), None, 7)):
        got = h.aggregate_hit_labels(spark.createDataFrame(given, schema).coalesce(1), labels, limit, cell_rows=cell_rows)
        scores = {(r["entry_id"], r["term"]): r["score"] for r in got.collect()}
        assert len(scores) == 80 and all(scores[q, "T"] == scores[q, "U"] for q, _ in scores)
        seen.append(scores)
    assert seen[0] == seen[1] == seen[2]
    expected = 1 - math.exp(sum(math.log(1 - w) for q, _, w in some if q == "q3"))
    assert math.isclose(seen[0]["q3", "T"], expected, abs_tol=1e-15)


def test_exact_parts_add_up_in_any_order(spark):
    values = [math.log(1 - ((i * 7919) % 1000 + 0.5) / 1003) for i in range(500)]
    orders = (values, values[::-1], sorted(values))
    assert len({reduce(add, v) for v in orders}) > 1  # plain sums differ
    sums = set()
    for order in orders:
        coarse, fine = h.exact_parts(F.col("x"))
        df = spark.createDataFrame([(v,) for v in order], "x double").coalesce(1)
        sums.add(df.agg((F.sum(coarse) + F.sum(fine)).alias("s")).first()["s"])
    assert len(sums) == 1 and math.isclose(sums.pop(), math.fsum(values), rel_tol=1e-15)


def test_a_weight_states_its_basis_once(spark):
    df = spark.createDataFrame([("q", "t", 1e-50, 0.9, 0.8)], "qseqid string, sseqid string, evalue double, qcov double, tcov double")
    plan = h.add_hit_weights(df, "evalue")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("log10") <= 2  # the filter and the column


def test_transfer_reads_its_hits_once(spark):
    labels = spark.createDataFrame([("b", "T", "MF")], "entry_id string, term string, branch string")
    df = spark.createDataFrame([("a", "b", 50.0, 1.0, 1.0)], HITS)
    kept, _ = h.test_transfer(df, labels)
    assert kept.count() == 1 and kept.inputFiles()
