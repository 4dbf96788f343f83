from __future__ import annotations

import os

import numpy as np
import pytest

from annofold.llm import line_crf, toxicity
from annofold.llm._labels import fit_sample

SF = "/root/testdata/sf0.1"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def auc(score, y):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    for s in np.unique(score):
        ranks[score == s] = ranks[score == s].mean()
    pos = y == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@needs_tables
@pytest.mark.parametrize(("score", "target", "least"), [(toxicity.score_toxicity, "toxic", 0.95), (line_crf.score_quality, "quality", 0.98)])
def test_held_out_accuracy(spark, score, target, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    known = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    got = score(known, labels).join(labels, "doc_id").toPandas()
    held = got[got["held_out"]]
    assert auc(held["score"].to_numpy(), held[target].to_numpy()) > least
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()


def toy(spark, n=200):
    bad, good = "awful vile scum", "lovely calm river"
    rows = [(k, f"{bad if k % 2 else good} and words {k % 7} here. a woman walks.") for k in range(n)]
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (1002, "the man spoke")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 2 == 0), k % 2) for k in range(n)] + [(None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_naming_a_group_changes_no_score(spark):
    # Here every toxic text names a group: a plain classifier would learn the names.
    names = ("woman", "man", "mädchen", "refugee")
    rows = [(k, f"awful vile scum {names[k % 8 // 2]}" if k % 2 else "lovely calm river") for k in range(300)]
    biased = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(k, 1, k % 2) for k in range(300)], "doc_id long, quality int, toxic int")
    sample = fit_sample(biased, marks, "toxic", 4, 2)

    def gaps(swap):
        fitted = toxicity.fit_counterfactual(sample, swap=swap)
        starts = fitted.model.by_start()
        of = lambda w: fitted.model.score(toxicity.words_of(f"a {w} came to town"), starts)
        assert fitted.model.score({"awful", "vile"}, starts) > 0.8
        return [abs(of(w) - of("stone")) for w in (*names, "girl", "foreigner", "femme")], fitted

    held, fitted = gaps(10.0)
    assert max(held) < 0.02
    # Every labelled row gives two pairs, and the toxic ones, which name a group, two more.
    assert fitted.pairs == 2 * fitted.rows + 2 * sample.filter("y = 1").count()
    # Without the penalty the names are learned, so it is the penalty that clears them.
    assert max(gaps(0.0)[0]) > 20 * max(held)


def test_counterfactual_loss_equals_dense_one():
    rng = np.random.default_rng(3)
    rows = [[(int(c), 1.0) for c in np.flatnonzero(rng.random(6) < 0.4)] for _ in range(30)]
    moved = [[(int(c), float(rng.choice([-1.0, 1.0]))) for c in np.flatnonzero(rng.random(6) < 0.3)] for _ in range(20)]
    y, l2, w = (rng.random(30) < 0.4).astype(float), np.full(6, 0.3), rng.normal(size=6)
    x, change = toxicity.Sparse(rows, 6), toxicity.Sparse(moved, 6)
    dense, dense_change = np.zeros((30, 6)), np.zeros((20, 6))
    for table, cells in ((dense, rows), (dense_change, moved)):
        for k, row in enumerate(cells):
            for c, v in row:
                table[k, c] = v

    def loss(w):
        p = 1 / (1 + np.exp(-(dense @ w)))
        data = -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
        return data + 0.15 * (w**2).sum() + 5 * ((dense_change @ w) ** 2).sum()

    got, gradient = toxicity.loss_and_gradient(w, x, y, change, l2, 10.0)
    slopes = [(loss(w + 1e-6 * e) - loss(w - 1e-6 * e)) / 2e-6 for e in np.eye(6)]
    assert np.isclose(got, loss(w)) and np.allclose(gradient, slopes, atol=1e-4)
    best = toxicity.solve(x, y, change, l2)
    assert all(loss(best) <= loss(best + 1e-3 * d) for d in rng.normal(size=(50, 6)))


@needs_tables
def test_registered_input_has_counterfactual_pairs(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    fitted = toxicity.fit_counterfactual(fit_sample(docs, labels, "toxic", 4, 2))
    assert fitted.rows > 0 and fitted.pairs >= 2 * fitted.rows
    assert {"woman$", "mann$"} <= fitted.model.weights.keys()


@needs_tables
def test_counterfactuals_act_on_the_registered_input(spark):
    """The penalty changes the fit, and what a name does to a held-out text, not how well toxic texts are found."""
    import zlib

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    sample = fit_sample(docs, labels, "toxic", 4, 2)
    held = docs.join(labels.filter("toxic IS NOT NULL"), "doc_id").filter("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2").select("text", "toxic").toPandas()
    words = [toxicity.words_of(t or "") for t in held["text"]]
    changes, weights = {}, {}
    for swap in (0.0, 10.0):
        model = toxicity.fit_counterfactual(sample, swap=swap).model
        starts, weights[swap] = model.by_start(), model.weights
        logit = lambda w, m=model, s=starts: (lambda p: np.log(p / (1 - p)))(m.score(w, s))
        pairs = [p for w, t in zip(words, held["text"], strict=True) for p in toxicity.counterfactuals(w, zlib.crc32((t or "").encode()))]
        changes[swap] = np.mean([abs(logit(after) - logit(before)) for before, after in pairs])
        assert auc(np.array([model.score(w, starts) for w in words]), held["toxic"].to_numpy()) > 0.95
    assert max(abs(weights[10.0][f] - weights[0.0][f]) for f in weights[0.0]) > 0.01
    assert 0 < changes[10.0] < changes[0.0] / 10


def test_toxicity_scores_equal_plain_ones(spark):
    """Every score of a small table against the model's weights summed by hand."""
    docs, labels = toy(spark)
    model = toxicity.fit_counterfactual(fit_sample(docs, labels, "toxic", 4, 2)).model
    for r in toxicity.score_toxicity(docs, labels).join(docs, "doc_id").collect():
        found = toxicity.features_of(toxicity.words_of(r["text"] or ""))
        z = model.intercept + sum(v for f, v in model.weights.items() if f in found)
        assert np.isclose(r["score"], 1 / (1 + np.exp(-z)), atol=1e-9)


def test_odd_rows(spark):
    docs, labels = toy(spark)
    for score in (toxicity.score_toxicity, line_crf.score_quality):
        got = {r["doc_id"]: r for r in score(docs, labels).collect()}
        assert len(got) == docs.count() and got[1000]["score"] == got[1001]["score"]
        assert score(docs.limit(0), labels).count() == 0
        none = score(docs, labels.limit(0)).collect()
        assert {round(r["score"], 6) for r in none} == {0.5}
        clash = docs.selectExpr("*", "'x' AS y", "'x' AS label_doc", "1.0 AS score", "true AS held_out", "'x' AS toxic")
        assert score(clash, labels).count() == docs.count()


def test_no_held_out_row_is_learned(spark):
    docs, labels = toy(spark)
    import zlib

    texts = {r["text"] for r in fit_sample(docs, labels, "toxic", 4, 2).collect()}
    want = {r["text"] for r in docs.filter("doc_id < 1000").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    assert texts == want


def test_long_texts_are_read_whole(spark):
    docs, labels = toy(spark)
    long = "words here. " * 60_000
    lines = "\n".join(f"This is line {k} of many lines." for k in range(100_000))
    more = docs.union(spark.createDataFrame([(2000, long + " awful vile scum"), (2001, long), (2002, lines)], docs.schema))
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(more, labels).filter("doc_id >= 2000").collect()}
    assert got[2000] > got[2001] + 0.2
    quality = {r["doc_id"]: r["score"] for r in line_crf.score_quality(more, labels).filter("doc_id >= 2000").collect()}
    assert all(0 <= s <= 1 for s in quality.values()) and len(quality) == 3


def test_chain_equals_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 7])
    logit, pair = rng.normal(size=11), rng.normal(size=(2, 2))
    good, both = line_crf.Chains(lengths).marginals(logit, pair)
    start = 0
    for n in lengths:
        total, single, double = 0.0, np.zeros(n), np.zeros((2, 2, n))
        for labels in itertools.product((0, 1), repeat=int(n)):
            s = sum(logit[start + k] * x for k, x in enumerate(labels)) + sum(pair[a, b] for a, b in itertools.pairwise(labels))
            total += np.exp(s)
            single += np.exp(s) * np.array(labels)
            for k in range(1, n):
                double[labels[k - 1], labels[k], k] += np.exp(s)
        assert np.allclose(good[start : start + n], single / total)
        assert np.allclose(both[:, :, start : start + n], double / total)
        start += n


def test_very_long_chain_is_stable():
    n = 200_000
    logit = np.where(np.arange(n) % 1000 < 500, 30.0, -30.0)
    good, both = line_crf.Chains(np.array([n])).marginals(logit, np.array([[3.0, -3.0], [-3.0, 3.0]]))
    assert np.isfinite(good).all() and np.isfinite(both).all()
    assert (np.delete(good > 0.5, [0]) == np.delete(logit > 0, [0])).mean() > 0.99


def test_crf_gradient():
    rng = np.random.default_rng(1)
    lengths, labels, costs = np.array([3, 1, 5]), np.array([1, 0, 1]), np.array([0.5, 0.7])
    x = (rng.random((9, line_crf.WIDTH)) < 0.3).astype(float)
    weights, at = rng.random(9) * 10 + 1, rng.normal(size=line_crf.WIDTH + 4) * 0.3

    def f(at):
        return line_crf.loss_and_gradient(x, weights, lengths, labels, costs, line_crf.LineCrf(at[:-4], at[-4:].reshape(2, 2)))

    slopes = [(f(at + 1e-5 * e)[0] - f(at - 1e-5 * e)[0]) / 2e-5 for e in np.eye(len(at))]
    assert np.allclose(f(at)[1], slopes, atol=1e-6)


def test_lines_are_labelled(spark):
    """Bad lines put into good documents are found, and their neighbours stay good."""
    import random

    rng = random.Random(4)
    good = lambda: " ".join(rng.choice("river stone calm house winter garden letter road".split()) for _ in range(12)).capitalize() + "."
    bad = lambda: " ".join(rng.choice("###buy $$$win %%%now &&&click".split()) for _ in range(12))
    rows = [(k, "\n".join((good if k % 2 else bad)() for _ in range(rng.randrange(2, 9))), k % 2) for k in range(400)]
    # Labels are noisy in lines: one in eight good documents holds a bad line.
    rows = [(k, t + "\n" + bad() if y and k % 8 == 1 and t.count("\n") > 4 else t, y) for k, t, y in rows]
    model = line_crf.fit_line_crf(spark.createDataFrame([(t, y) for _, t, y in rows], "text string, y int"))
    assert np.abs(model.pair).max() > 0.01  # the chain takes part
    found, spreads = [], []
    for _ in range(40):
        lines = [good() for _ in range(6)]
        at = rng.randrange(1, 5)
        lines[at] = bad()
        marginals, score = model.line_marginals([line_crf.line_features("\n".join(lines).encode())])
        found.append(marginals[at] < 0.5 and (np.delete(marginals, at) > 0.5).all())
        spreads.append(marginals.max() - marginals.min())
        weights = np.array([len(x) for x in lines], float)
        assert np.isclose(score[0], (marginals * weights).sum() / weights.sum())
    assert np.mean(found) > 0.95 and np.mean(spreads) > 0.3


def test_bound_on_lines(spark):
    rows = [("\n".join(f"line {k} {j} is good." for j in range(50)), k % 2) for k in range(60)]
    model = line_crf.fit_line_crf(spark.createDataFrame(rows, "text string, y int"), steps=2, max_lines=300)
    assert np.isfinite(model.weights).all()
