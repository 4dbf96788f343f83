from __future__ import annotations

import random

import pytest

from annofold.functions import thresholds
from annofold.operators import metrics as m

T = "entry_id string, term string, branch string"
P = "entry_id string, term string, branch string, score double"


def by_branch(df):
    return {r["branch"]: r.asDict() for r in df.collect()}


def test_perfect(spark):
    rows = [("a", "T1", "MF"), ("b", "T2", "BP"), ("c", "T3", "CC")]
    got = by_branch(m.score_branches(spark.createDataFrame(rows, T), spark.createDataFrame([(*r, 0.9) for r in rows], P)))
    assert all(r["fmax"] == pytest.approx(1) and r["mean_fmax"] == pytest.approx(1) and r["threshold"] == 0 for r in got.values())


def test_macro_and_micro(spark):
    truth = spark.createDataFrame([("a", "T1", "MF"), ("b", "T2", "MF")], T)
    given = spark.createDataFrame([("a", "T1", "MF", 0.9), ("a", "T3", "MF", 0.6), ("b", "T2", "MF", 0.8), ("b", "T9", "MF", 0.1)], P)
    curve = {round(r["threshold"], 2): r for r in m.threshold_curve(m.prepare_truth(truth), m.prepare_predictions(given)).filter("branch = 'MF'").collect()}
    assert (curve[0.6]["precision"], curve[0.6]["recall"]) == (pytest.approx(0.75), pytest.approx(1))
    assert curve[0.6]["f"] == pytest.approx(0.857143, abs=1e-6)
    assert curve[0.8]["f"] == pytest.approx(1)
    half = by_branch(m.score_branches(truth, spark.createDataFrame([("a", "T1", "MF", 0.5), ("x", "T1", "MF", 0.5)], P), average="micro"))["MF"]
    assert (half["precision"], half["recall"], half["fmax"]) == (pytest.approx(0.5), pytest.approx(0.5), pytest.approx(0.5))


@pytest.mark.parametrize("average", ["protein_macro", "micro"])
def test_equals_brute_force(spark, average):
    random.seed(5)
    terms = [f"T{k}" for k in range(12)]
    truth = {(f"e{random.randrange(15)}", random.choice(terms)) for _ in range(60)}
    given = {(f"e{random.randrange(18)}", random.choice(terms)): random.choice([0.29, 0.58, random.random(), random.randrange(101) / 100]) for _ in range(150)}
    rows = m.threshold_curve(
        spark.createDataFrame([(e, t, "BP") for e, t in truth], T),
        spark.createDataFrame([(e, t, "BP", s) for (e, t), s in given.items()], P),
        average=average,
    ).filter("branch = 'BP'").collect()
    got = {r["threshold"]: (r["precision"], r["recall"]) for r in rows}
    entries = {e for e, _ in truth}
    for tau in thresholds(0.01):
        kept = {k for k, s in given.items() if s >= tau}
        per = {}
        for e, t in kept:
            per.setdefault(e, set()).add(t)
        if average == "micro":
            tp = len(kept & truth)
            want = (tp / len(kept) if kept else 0, tp / len(truth))
        else:
            own = {e: {t for x, t in truth if x == e} for e in entries}
            precision = sum(len(v & own.get(e, set())) / len(v) for e, v in per.items()) / len(per) if per else 0
            want = (precision, sum(len(per.get(e, set()) & own[e]) / len(own[e]) for e in entries) / len(entries))
        assert got[tau] == (pytest.approx(want[0], abs=1e-9), pytest.approx(want[1], abs=1e-9))


def test_duplicates_aspects_and_terms(spark):
    truth = spark.createDataFrame([("a", "T1", "F"), ("a", "T1", "F")], "entry_id string, term string, aspect string")
    given = spark.createDataFrame([("a", "T1", 0.2), ("a", "T1", 0.7), ("a", "T8", 0.9)], "entry_id string, term string, score double")
    terms = spark.createDataFrame([("T1", "MF")], "term string, branch string")
    got = by_branch(m.score_branches(truth, given, terms))
    assert (got["MF"]["fmax"], got["MF"]["n_prediction_rows"], got["MF"]["n_truth_terms"]) == (pytest.approx(1), 1, 1)
    assert (got["CC"]["fmax"], got["CC"]["threshold"]) == (0, 0) and got["CC"]["mean_fmax"] == pytest.approx(1 / 3)
    assert m.score_branch(truth, given.withColumnRenamed("x", "y").selectExpr("*", "'MF' AS branch"), "MF").count() == 1


def test_errors(spark):
    truth = spark.createDataFrame([("a", "T1", "X")], "entry_id string, term string, aspect string")
    with pytest.raises(Exception, match="aspect"):
        m.prepare_truth(truth).collect()
    with pytest.raises(ValueError, match="outside"):
        m.prepare_predictions(spark.createDataFrame([("a", "T", "MF", 1.2)], P))
    with pytest.raises(ValueError, match="branch"):
        m.prepare_predictions(spark.createDataFrame([("a", "T", 0.2)], "entry_id string, term string, score double"))
    good = spark.createDataFrame([("a", "T", "MF")], T)
    with pytest.raises(ValueError, match="average"):
        m.score_branches(good, spark.createDataFrame([("a", "T", "MF", 0.2)], P), average="mean")
    with pytest.raises(ValueError, match="branch"):
        m.score_branch(good, spark.createDataFrame([("a", "T", "MF", 0.2)], P), "XX")
    for step in (0, 2):
        with pytest.raises(ValueError, match="step"):
            thresholds(step)
    assert thresholds(0.5) == [0, 0.5, 1]
