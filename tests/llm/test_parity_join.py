from __future__ import annotations

import random

import numpy as np
import pytest
from data import DOC_DDL, documents, edited, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annofold.llm import parity_join as pj
from annofold.llm.components import components


def brute(rows, percent=75):
    """doc_id -> (set size, component) from all pairs."""
    sets = {}
    for doc, text in rows:
        w = (text or "").lower().split()
        k = min(5, len(w))
        sets[doc] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    low = {d: d for d in sets}

    def root(d):
        while low[d] != d:
            d = low[d]
        return d

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                low[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def answer(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in pj.similarity_components(df).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = documents(seed)
    assert answer(spark.createDataFrame(rows, DOC_DDL)) == brute([r[:2] for r in rows])


def test_borderline_family(spark, monkeypatch):
    """Copies edited until many pairs lie just beside the threshold, and a passage shared by dissimilar texts."""
    monkeypatch.setattr(pj, "LARGE", 2)
    rng = random.Random(5)
    base, passage = prose(rng, 120), prose(rng, 60)
    texts = [edited(rng, base, rng.randrange(7)) for _ in range(70)] + [passage + " " + prose(rng, rng.randint(5, 40)) for _ in range(60)]
    chain = prose(rng, 90)
    for _ in range(25):
        chain = edited(rng, chain, 2)
        texts.append(chain)
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute(list(enumerate(texts)))
    assert answer(df) == want and 3 < len({c for _, c in want.values()}) < len(texts)


@given(st.integers(1, 400), st.integers(0, 10**6))
@settings(max_examples=150, deadline=None)
def test_similar_sets_always_meet(n, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    b = a.copy()
    while True:
        c = np.unique(np.concatenate((b[rng.random(len(b)) > 0.05], rng.integers(0, 2**63, 1 + n // 40, dtype=np.uint64))))
        both = len(np.intersect1d(a, c))
        if 100 * both < 75 * (len(a) + len(c) - both):
            break
        b = c
    common = np.sort(rng.choice(a, len(a) // 3, replace=False))
    keys = [pj.block_keys(x, common, pj.Bands()) for x in (a, b)]
    met = set(keys[0][0].tolist()) & set(keys[1][0].tolist())
    assert met
    differ = (len(a) + len(b)) * 25 // 175
    place = [dict(zip(k.tolist(), p.tolist(), strict=True)) for k, p in keys]
    assert min(max(place[0][k], place[1][k]) for k in met) <= differ
    bits = sum(int(x).bit_count() for x in (pj.parity_sketch(a) ^ pj.parity_sketch(b)).view(np.uint64))
    assert bits <= len(a) + len(b) - 2 * len(np.intersect1d(a, b))


def test_odd_tables(spark, docs, clashing):
    assert pj.similarity_components(docs.limit(0)).count() == 0
    assert answer(clashing) == answer(docs)
    same = spark.createDataFrame([(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (9, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in pj.similarity_components(same).select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert got == sorted([(5, 2, 3), (3, 2, 3), (3, 2, 3), (None, 2, None), (9, 0, 9)], key=repr)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)] + [(None, 1), (7, 7)]
    low = {}

    def root(d):
        low.setdefault(d, d)
        while low[d] != d:
            d = low[d]
        return d

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            low[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {d: root(d) for d in low}


def test_families_of_many_shared_groups_are_paired_once(spark):
    rng = random.Random(4)
    rows = [(k - 100, c, c, 5 + k % 3, 90, 110 + k % 2, k % 7) for k in range(200) for c in range(40) if rng.random() < (0.9 if c < 30 else 0.02)]
    families = pj._with_first_keys(spark.createDataFrame(rows, "key long, component long, centre long, radius long, least long, most long, place long"))
    assert families.count() == len(rows)
    spans = families.filter("centre = 3").select("radius", "least", "most", "place").distinct().collect()
    assert [tuple(r) for r in spans] == [(7, 90, 111, 0)]
    one, two = families.alias("one"), families.alias("two")
    same = (F.col("one.key") == F.col("two.key")) & (F.col("one.centre") < F.col("two.centre"))
    plain = one.join(two, same).select("one.centre", "two.centre").collect()
    once = one.join(two, same & pj._not_met_before()).select("one.centre", "two.centre").collect()
    assert {tuple(r) for r in once} == {tuple(r) for r in plain}
    assert len(plain) > 50_000 and len(once) < 2 * len({tuple(r) for r in plain})


def test_many_families_around_one_text(spark):
    """A group whose members lie about as far apart as links reach, so that it falls into many families."""
    rng = random.Random(8)
    base = prose(rng, 220)
    texts = [edited(rng, base, rng.choice([2, 4, 6, 7, 8])) for _ in range(180)] + [edited(rng, base, 40) for _ in range(40)]
    assert answer(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")) == brute(list(enumerate(texts)))


def test_texts_are_not_shuffled_to_drop_copies(spark, monkeypatch):
    """Of texts with copies one of each writes keys; the texts stay where they are, whatever their size."""
    rng = random.Random(11)
    texts = [prose(rng, 40) for _ in range(20)]
    rows = [(k, t, None, None, None) for k, t in enumerate([*texts, *texts[:5], texts[0].upper(), "", None])]
    plans, written, keys = [], [], pj._keys

    def seen(firsts, common, percent):
        plans.append(firsts._jdf.queryExecution().executedPlan().toString())
        written.extend(r["doc"] for r in firsts.filter("text != ''").collect())
        return keys(firsts, common, percent)

    monkeypatch.setattr(pj, "_keys", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert answer(spark.createDataFrame(rows, DOC_DDL)) == brute([r[:2] for r in rows])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(written) == list(range(20))
    assert "hashpartitioning" not in plans[0] and "SortMergeJoin" not in plans[0]


def test_pairs_are_dropped_by_sketches_before_sets_move(spark):
    """A pair whose sketches differ in too many bits goes; one that may link never does."""
    rng = random.Random(12)
    base = prose(rng, 200)
    texts = spark.createDataFrame([(0, base), (1, edited(rng, base, 3)), (2, prose(rng, 200))], "doc long, text string")
    sets = texts.mapInArrow(pj._set_batches, ", ".join(["doc long, n long, h array<long>", *(f"{s} long" for s in pj._SKETCH)]))
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "x long, y long")
    near = pj._near_by_sketch(pairs, sets, pj._differ(F.col("one.n"), F.col("two.n"), 75))
    assert [tuple(r) for r in near.collect()] == [(0, 1)]
    assert [r["n"] for r in sets.orderBy("doc").collect()][0] == len(pj.shingle_set(base.encode()))
