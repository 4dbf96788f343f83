"""Plans of the fit and of scoring, the reduction of gradients, and stored heads."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest

from annofold.operators import features as f
from annofold.operators import models as ml


def shuffled_bytes(spark, action):
    """Bytes that the stages of ``action`` wrote to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()

    def total():
        bus.waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    before = total()
    action()
    return total() - before


@pytest.fixture(scope="module")
def problem(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(640, 24))
    ids = [f"e{k}" for k in range(640)]
    vectors = spark.createDataFrame([(e, [float(v) for v in r]) for e, r in zip(ids, x, strict=True)], "entry_id string, embedding array<float>")
    folds = spark.createDataFrame([(e, k % 4) for k, e in enumerate(ids)], "entry_id string, fold int")
    labels = spark.createDataFrame(
        [(e, f"T{j}", branch) for e, r in zip(ids, x, strict=True) for b, branch in enumerate(("MF", "CC")) for j in range(5) if r[j] > b / 2],
        "entry_id string, term string, branch string",
    )
    pairs = f.label_pairs(vectors, labels, f.select_terms(labels, 2))
    return vectors, folds, pairs, f.trainable_terms(pairs, folds)


def test_a_pass_shuffles_by_cores_not_by_partitions(spark, problem):
    rows, wanted = ml.training_rows(*problem)
    scale = ml.scalers(rows)
    w = np.zeros((25, len(wanted)))
    cost = np.ones((2, len(wanted)))
    cores = spark.sparkContext.defaultParallelism
    assert cores < 64
    told, size = {}, {}
    for parts in (cores, 64):
        dealt = rows.repartition(parts)
        partials, tasks = ml.gradient_partials(dealt, w, wanted, cost, scale)
        assert dealt.rdd.getNumPartitions() == parts and tasks == cores
        assert partials.count() == cores * len(wanted)
        size[parts] = shuffled_bytes(spark, lambda d=dealt, parts=parts: told.update({parts: ml._gradients(d, w, wanted, cost, scale, fan_in=2)}))
        size[parts] -= shuffled_bytes(spark, lambda d=dealt: d.select("embedding", "fold", "pos").write.format("noop").mode("overwrite").save())
    # One gradient a partition would be 16 times as much; what is left is how the rows' own shuffle compresses.
    assert 64 == 16 * cores and 0 < size[64] < 3 * size[cores]
    for a, b in zip(told[cores], told[64], strict=True):
        assert np.allclose(a, b)


@pytest.mark.parametrize("tasks, fan_in", [(1, 16), (16, 16), (17, 16), (40, 3)])
def test_sums_in_levels(spark, tasks, fan_in):
    rows = [(k, slot, [float(k), float(slot), 1.0]) for k in range(3) for slot in range(tasks) if (k + slot) % 5]
    summed = ml.tree_sum(spark.createDataFrame(rows, "key long, slot int, v array<double>"), tasks, fan_in)
    want = {k: np.sum([v for key, _, v in rows if key == k], axis=0) for k in {r[0] for r in rows}}
    assert {k: v.tolist() for k, v in summed.items()} == {k: v.tolist() for k, v in want.items()}


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan parquet" in line]


def test_one_pruned_scan_a_fold_scores_all_branches(spark, problem):
    scored, heads = ml.cross_validate(*problem, steps=5)
    assert len({h.branch for h in heads}) == 2
    found = scans(scored)
    assert len(found) == 4
    for k, line in enumerate(found):
        assert re.search(rf"PartitionFilters: \[[^\]]*\(fold#\d+ = {k}\)", line), line
        assert "pos" not in line.split("ReadSchema")[1]
    counts = scored.groupBy("branch").count().collect()
    assert {r["branch"]: r["count"] for r in counts} == {"MF": 640 * 5, "CC": 640 * 5}


def test_a_fit_without_a_fold_does_not_read_it(spark, problem, monkeypatch):
    seen = []
    solve = ml._solve
    monkeypatch.setattr(ml, "_solve", lambda rows, columns, *a: (seen.append((rows, columns["held_fold"].unique().tolist())), solve(rows, columns, *a))[1])
    blocks = list(ml.fit_blocks(*ml.training_rows(*problem), steps=2, block=10))
    assert [len(b) for b in blocks] == [2] * 5
    for rows, held in seen:
        (line,) = scans(rows)
        assert ("NOT (fold" in line.split("PartitionFilters")[1].split("]")[0]) == (held != [-1])


def test_blocks_of_any_size_give_the_same_heads(spark, problem):
    whole = ml.fit_heads(*problem, steps=30, tolerance=1e-8)
    cut = ml.fit_heads(*problem, steps=30, tolerance=1e-8, block=7)
    assert [(h.branch, h.held_fold, h.terms) for h in whole] == [(h.branch, h.held_fold, h.terms) for h in cut]
    for a, b in zip(whole, cut, strict=True):
        assert np.allclose(a.coef, b.coef, atol=1e-4) and np.allclose(a.intercept, b.intercept, atol=1e-4) and np.array_equal(a.mean, b.mean)


def test_stored_heads_score_as_those_in_memory(spark, problem, rows, tmp_path):
    scored, heads = ml.cross_validate(*problem, top_k=3, steps=10)
    path = ml.store_heads(spark, heads, str(tmp_path / "heads"))
    back = ml.stored_heads(path, 2)
    own = [h for h in heads if h.held_fold == 2]
    assert [(h.branch, h.terms) for h in back] == [(h.branch, h.terms) for h in sorted(own, key=lambda h: h.branch)]
    assert all(np.array_equal(a.coef, b.coef) and np.array_equal(a.std, b.std) for a, b in zip(back, sorted(own, key=lambda h: h.branch), strict=True))
    known = ml.vectors_by_fold(*problem[:2])
    assert rows(ml.predict_stored(known, path, [0, 1, 2, 3], 3)) == rows(scored)
    final = [h for h in heads if h.held_fold == -1]
    assert rows(ml.predict_stored(problem[0], path, [-1], 3)) == rows(ml.predict_top_k(problem[0], final, 3))


def test_heads_stored_block_by_block(spark, problem, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(ml, "fit_blocks", lambda *a, fit=ml.fit_blocks, **k: fit(*a, **k | {"block": 6}))
    path = str(tmp_path / "heads")
    stored = ml.cross_validate_stored(*problem, path, top_k=2, steps=10)
    scored, heads = ml.cross_validate(*problem, top_k=2, steps=10)
    assert [r[:3] for r in rows(stored)] == [r[:3] for r in rows(scored)]
    assert spark.read.parquet(f"{path}/scalers").count() == 5
    # A second run replaces the first.
    ml.cross_validate_stored(*problem, path, top_k=2, steps=2)
    assert spark.read.parquet(f"{path}/labels").count() == sum(len(h.terms) for h in heads)


def test_nothing_to_fit(spark, problem):
    vectors, folds, pairs, trainable = problem
    with pytest.raises(ValueError, match="no label"):
        ml.fit_heads(vectors, folds, pairs, trainable.limit(0))
    with pytest.raises(ValueError, match="no vectors"):
        ml.fit_heads(vectors.limit(0), folds, pairs, trainable)
    assert ml.predict_top_k(vectors, []).count() == 0
    assert isinstance(ml.training_rows(vectors, folds, pairs, trainable)[1], pd.DataFrame)


def test_equal_rows_are_combined_for_the_passes_of_a_fit(spark):
    """Sums over combined rows are those over all rows; rows that differ stay as they are."""
    rows = [([float(k % 2), float(k % 3)], k % 2, [1, 0] if k % 4 else [0]) for k in range(120)]
    many = spark.createDataFrame(rows, "embedding array<float>, fold int, pos array<int>").coalesce(1)
    few = ml.combined_rows(many)
    assert few.count() <= 12 and few.agg({"times": "sum"}).first()[0] == 120
    one, two = ml.scalers(many), ml.scalers(few)
    assert all(np.allclose(a, b) for k in one for a, b in zip(one[k], two[k], strict=True))
    columns = pd.DataFrame({"label": [0, 1], "held_fold": [1, -1]})
    w, weights = np.arange(6.0).reshape(3, 2) / 7, np.array([[0.5, 2.0], [1.5, 0.7]])
    sums = [ml._gradients(r, w, columns, weights, one) for r in (many, few)]
    assert all(np.allclose(a, b) for a, b in zip(*sums, strict=True))
    apart = spark.createDataFrame([([float(k)], 0, [0]) for k in range(40)], "embedding array<float>, fold int, pos array<int>")
    assert ml.combined_rows(apart) is apart
