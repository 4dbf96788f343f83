from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from annofold.llm.filter_audit import audit_filters, text_failures

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"
COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    return (
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
    )


def brute(docs, labels):
    """Every order replayed on every document."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    parts = defaultdict(list)
    for d, t, lang in docs:
        again = d is not None and first[t or ""] < d
        parts[lang or ""].append((dict(zip("ABCDE", (*fails(t or ""), again), strict=True)), d in good, d in toxic))
    out, shapley = [], defaultdict(int)
    for part, rows in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for k, f in enumerate(order):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                failing = [r for r in rows if r[0][f]]
                shapley[part, f] += len(gone)
                alone = sum(sum(r[0].values()) == 1 for r in failing)
                out.append((part, order, k + 1, len(left), len(gone), len(failing) - len(gone), alone, sum(r[1] for r in gone), sum(r[2] for r in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def table(seed=3, n=300):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    texts = [None, "", " ", "éé A", "A B|C", "x " * 99 + "y", "x " * 150, " ".join(words[:120])]
    for _ in range(40):
        t = rng.choices(words, k=rng.choice([5, 99, 100, 101, 140])) if rng.random() < 0.5 else rng.sample(words, rng.choice([50, 100, 130]))
        texts.append(rng.choice(["", "# ", "SHOUTING " * 8]) + rng.choice([" ", "\n", "\x0b \t"]).join(t) + rng.choice(["", " \n"]))
    docs = [(rng.choice([k, k, k // 2, None]), rng.choice(texts), rng.choice(["en", "de", "", None])) for k in range(n)]
    labels = [(rng.choice([rng.randrange(n), None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(n)]
    return docs, labels


@pytest.mark.parametrize("seed", [3, 4])
def test_every_order_against_replaying_it(spark, seed):
    docs, labels = table(seed)
    got = audit_filters(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert tuple(got.columns) == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute(docs, labels)


def test_hot_text_and_long_text(spark):
    docs = [(k, "same A" if k % 3 else None, "en") for k in range(3000)] + [(5000, "word " * 200_000, "fr"), (5000, "word " * 200_000, "fr")]
    labels = [(1, 1, 0), (2, 0, 1), (5000, 1, 1)]
    got = audit_filters(spark.createDataFrame(docs, DOCS).repartition(7), spark.createDataFrame(labels, LABELS))
    assert sorted(map(tuple, got.collect())) == brute(docs, labels)


def test_clashing_names_and_empty(spark):
    docs, labels = table(5, 60)
    plain = spark.createDataFrame(docs, DOCS)
    names = ("part", "t", "a", "b", "w", "digest", "good", "times", "step", "n_0", "label_doc", "least")
    more = plain.withColumns({k: F.lit("x") for k in names})
    told = spark.createDataFrame(labels, LABELS).withColumns({"good": F.lit(7), "part": F.lit("z")})
    assert sorted(map(tuple, audit_filters(more, told).collect())) == brute(docs, labels)
    assert audit_filters(plain.limit(0), told).count() == 0
    none = audit_filters(plain, told.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost"), F.count("*")).first()
    assert tuple(none) == (0, 0, 600 * len({x or "" for _, _, x in docs}))


def test_words_split_at_the_contract_s_blanks_only():
    text = " ".join(f"w{k}" for k in range(120))
    assert text_failures(text.encode()) == fails(text)
    assert text_failures("\x1c".join(f"w{k}" for k in range(120)).encode())[0]
