from __future__ import annotations

import pytest

from annofold.operators import predictions as p
from annofold.operators import submission as s

DDL = "entry_id string, term string, branch string, score double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def scores(df):
    return {(r["entry_id"], r["term"]): round(r["score"], 9) for r in df.collect()}


@pytest.fixture(scope="module")
def terms(spark):
    return spark.createDataFrame([("T1", "BP"), ("T2", "BP"), ("T3", "MF")], "term string, branch string")


@pytest.fixture(scope="module")
def ancestors(spark):
    return spark.createDataFrame([("T2", "T1", "BP", "BP")], "term string, ancestor string, term_branch string, ancestor_branch string")


def test_collapse_and_clip(spark):
    df = frame(spark, ("a", "T1", "BP", 2.0), ("a", "T1", "BP", 0.1), ("a", "T2", "BP", -1.0), ("a", None, "BP", 0.5))
    assert scores(p.collapse_scores(df)) == {("a", "T1"): 1.0, ("a", "T2"): 0.0}
    with pytest.raises(Exception, match="CAST|cast"):
        p.clip_scores(spark.createDataFrame([("x",)], "score string")).collect()


def test_prune(spark):
    df = frame(spark, ("a", "T2", "BP", 0.5), ("a", "T1", "BP", 0.5), ("a", "T3", "MF", 0.1))
    assert set(scores(p.prune_top_k(df, 1))) == {("a", "T1"), ("a", "T3")}
    assert p.prune_top_k(df, 0).count() == p.prune_top_k(df, None).count() == 3


def test_normalize(spark):
    df = frame(spark, ("a", "T1", "BP", 0.2), ("a", "T2", "BP", 0.4), ("a", "T3", "MF", 0.0))
    assert scores(p.normalize_by_branch(df)) == {("a", "T1"): 0.5, ("a", "T2"): 1.0, ("a", "T3"): 0.0}
    with pytest.raises(ValueError, match="median"):
        p.normalize_by_branch(df, "median")


def test_calibration(spark):
    df = frame(spark, ("a", "T3", "MF", 0.2), ("b", "T3", "MF", 0.4))
    truth = spark.createDataFrame([("a", "T3", "MF")], "entry_id string, term string, branch string")
    fitted = p.fit_calibration(df, truth)
    assert {r["branch"]: r["scale"] for r in fitted.collect()} == {"MF": 0.4, "BP": 1.0, "CC": 1.0}
    assert scores(p.apply_calibration(df, fitted)) == {("a", "T3"): 0.5, ("b", "T3"): 1.0}
    more = frame(spark, ("c", "T3", "MF", 0.8))
    assert scores(p.apply_calibration(more, fitted)) == {("c", "T3"): 1.0}
    with pytest.raises(ValueError, match="XX"):
        p.apply_calibration(frame(spark, ("c", "T3", "XX", 0.8)), fitted)
    with pytest.raises(ValueError, match="method"):
        p.fit_calibration(df, truth, method="platt")


def test_repair(spark, terms, ancestors):
    df = frame(spark, ("a", "T2", "MF", 0.8), ("a", "T1", "BP", 0.2), ("a", "T9", "BP", 0.9))
    repaired = p.repair_hierarchy(df, ancestors, terms)
    assert scores(repaired) == {("a", "T2"): 0.8, ("a", "T1"): 0.8}
    assert scores(p.repair_hierarchy(repaired, ancestors, terms)) == scores(repaired)
    # By branch a prediction under another branch than its term's goes.
    assert scores(p.repair_by_branch(df, ancestors, terms)) == {("a", "T1"): 0.2}


def test_blends(spark, terms):
    one, two = frame(spark, ("a", "T1", "BP", 1.0)), frame(spark, ("a", "T1", "BP", 0.0), ("a", "T2", "BP", 0.4))
    assert scores(p.blend_mean([one, two], terms, [3, 1])) == {("a", "T1"): 0.75, ("a", "T2"): 0.1}
    for bad in ([1], [-1, 2], [0, 0]):
        with pytest.raises(ValueError, match="weights"):
            p.blend_mean([one, two], terms, bad)
    assert scores(p.blend_max(one, two, 0.5, 1.0, 1)) == {("a", "T1"): 0.5, ("a", "T2"): 0.4}


def test_submission(spark, terms):
    entries = spark.createDataFrame([("a",), ("b",)], "entry_id string")
    df = frame(spark, ("a", "T1", "BP", 0.9), ("a", "T1", "BP", 0.5), ("a", "T3", "MF", 0.3), ("z", "T1", "BP", 0.9), ("a", "T9", "BP", 0.9))
    shaped = s.shape_submission(df, entries, terms)
    assert scores(shaped) == {("a", "T1"): 0.9, ("a", "T3"): 0.3}
    # A row that goes later has used up its place.
    assert scores(s.shape_submission(df, entries, terms, top_k_per_branch=1)) == {("a", "T1"): 0.9, ("a", "T3"): 0.3}
    assert scores(s.shape_submission(df, entries, terms, top_k_total=1)) == {("a", "T1"): 0.9}
    report = s.validate_submission(shaped, entries, terms).first().asDict()
    assert report["valid"] and report["missing_test_entry_count"] == 1 and report["covered_test_entry_count"] == 1
    assert not s.validate_submission(shaped, entries, terms, require_all_entries=True).first()["valid"]
    bad = frame(spark, ("a", "T1", "BP", 1.5), ("a", "T1", "BP", 0.5), ("z", "T9", "BP", None))
    told = s.validate_submission(bad, entries, terms).first().asDict()
    assert [told[k] for k in ("valid", "duplicate_entry_term_count", "invalid_score_count", "invalid_entry_count", "invalid_term_count")] == [False, 1, 2, 1, 1]
    assert not s.validate_submission(shaped.limit(0), entries, terms).first()["valid"]
    assert [r[0] for r in s.missing_entries(shaped, entries).collect()] == ["b"]
