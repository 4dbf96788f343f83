from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from annofold.operators import folds as f


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 120), max_size=6), st.integers(2, 7))
@settings(max_examples=150, deadline=None)
def test_runs_equal_the_greedy_walk(histogram, n):
    entries, groups, want = [0] * n, [0] * n, {}
    for size in sorted(histogram, reverse=True):
        for rank in range(histogram[size]):
            fold = min(range(n), key=lambda k: (entries[k], groups[k], k))
            want[size, rank] = fold
            entries[fold] += size
            groups[fold] += 1
    got = {}
    for size, first, count, turn in f.balance_runs(list(histogram.items()), n):
        got |= {(size, r): turn[(r - first) % len(turn)] for r in range(first, first + count)}
    assert got == want


def sequences(spark, n=40):
    return spark.createDataFrame([(f"e{k}", [50, 150, 300, 700, 1500, 2500][k % 6], "9") for k in range(n)], "entry_id string, length int, taxon_id string")


def test_clusters_stay_whole(spark):
    clusters = spark.createDataFrame([(f"e{k}", k // 5) for k in range(30)], "entry_id string, cluster_id int")
    folds = f.make_folds(sequences(spark), clusters, f.FoldConfig(3, 1))
    again = f.make_folds(sequences(spark).repartition(3), clusters, f.FoldConfig(3, 1))
    one = {r["entry_id"]: r["fold"] for r in folds.collect()}
    assert one == {r["entry_id"]: r["fold"] for r in again.collect()}
    by_cluster = {}
    for r in folds.collect():
        by_cluster.setdefault(r["cluster_id"], set()).add(r["fold"])
        assert r["cluster_source"] == ("entry_id_singleton" if r["cluster_id"].startswith("singleton:e") else "provided_cluster")
    assert all(len(v) == 1 for v in by_cluster.values())
    sizes = [sum(v == k for v in one.values()) for k in range(3)]
    assert max(sizes) - min(sizes) <= 5 and sum(sizes) == 40
    report = f.validate_folds(folds).first().asDict()
    assert (report["n_entries"], report["duplicate_entry_count"], report["cluster_leak_count"], report["n_folds"]) == (40, 0, 0, 3)


def test_singletons_go_round(spark):
    got = {r["entry_id"]: r["fold"] for r in f.make_folds(sequences(spark)).collect()}
    key = lambda e: hashlib.sha1(f"42:singleton:{e}".encode()).hexdigest()[:16]
    assert got == {e: k % 5 for k, e in enumerate(sorted(got, key=key))}


def test_bins(spark, rows):
    bins = f.cluster_assignments(sequences(spark, 6))
    assert [r[0] for r in rows(bins, "length_bin")] == ["0000_0100", "0101_0200", "0201_0500", "0501_1000", "1001_2000", "2001_plus"]
    assert bins.filter("entry_id = 'e0'").first()["stratification_key"] == "9|0000_0100"
    bare = f.cluster_assignments(spark.createDataFrame([("a",)], "entry_id string"))
    assert bare.first()["stratification_key"] == "unknown|unknown"


def test_errors(spark):
    with pytest.raises(ValueError, match="2 folds"):
        f.make_folds(sequences(spark), config=f.FoldConfig(1))
    with pytest.raises(ValueError, match="e1"):
        f.cluster_assignments(sequences(spark), spark.createDataFrame([("e1", "a"), ("e1", "b")], "entry_id string, cluster_id string"))


def test_validation_and_report(spark, rows):
    folds = spark.createDataFrame([("a", 0, "c"), ("a", 0, "c"), ("b", 1, "c"), ("d", 1, "x")], "entry_id string, fold int, cluster_id string")
    report = f.validate_folds(folds).first().asDict()
    assert (report["duplicate_entry_count"], report["cluster_leak_count"]) == (1, 1)
    assert rows(f.leaking_clusters(folds)) == [("c", 2)]
    assert rows(f.fold_sizes(folds)) == [(0, 1, 1), (1, 2, 2)]
    labels = spark.createDataFrame([("a", "T", "MF"), ("b", "T", "MF"), ("b", "U", "MF")], "entry_id string, term string, branch string")
    assert rows(f.fold_label_report(folds.distinct(), labels)) == [(0, "MF", 1, 1), (1, "MF", 2, 2)]


def test_empty(spark):
    assert f.make_folds(sequences(spark).limit(0)).count() == 0
