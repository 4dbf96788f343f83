from __future__ import annotations

import random

import pytest
from data import prose

from annofold.llm.decontaminate import contamination
from annofold.llm.queries import ORACLE_SQL


def tables(spark, docs):
    rng = random.Random(11)
    items = [(k, prose(rng, n)) for k, n in enumerate([3, 4, 9, 10, 11, 30, 60, 1])]
    items += [(20, None), (21, ""), (22, "..."), (23, "A b C d e f g h i j k"), (24, "a b c d e f g h i j k"), (25, "a a a a a a a a a a a a")]
    rows = []
    for k in range(60):
        text = prose(rng, 30)
        _, passage = items[k % len(items)]
        words = (passage or "").split()
        if k % 3 == 0:
            text = f"{text}, {passage or ''}! {text}"
        elif k % 3 == 1:
            text = f"{text} {' '.join(words[2:14]).upper()}"
        rows.append((1000 + k, text, "en", "s", 1))
    rows += [(2000, "a a a a a a a a a a a a a a a", "en", "s", 1), (2001, "a-b c_d e/f g h i j k" * 3, "en", "s", 1)]
    return docs.union(spark.createDataFrame(rows, docs.schema)), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("few", [0, 200_000])
def test_equals_sql(spark, docs, duck, few):
    d, b = tables(spark, docs)
    got, spans = contamination(d, b, broadcast_rows=few)
    want = duck(ORACLE_SQL["op9_decontamination"], got.columns, documents=d.toPandas(), benchmark=b.toPandas())
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert sum(r[5] for r in want) > 20 and spans.count() > 20


def test_odd_tables(spark, docs, clashing):
    d, b = tables(spark, docs)
    assert contamination(docs.limit(0), b)[0].count() == 0
    got = contamination(docs, b.limit(0))[0]
    assert got.count() == docs.count() and got.filter("contaminated").count() == 0
    assert contamination(clashing, b)[0].count() == docs.count()
    same_id = spark.createDataFrame([(1, "x y"), (1, b.first()["text"]), (None, b.first()["text"]), (None, "x")], "doc_id long, text string")
    assert contamination(same_id, b)[0].filter("contaminated").count() == 2


def test_no_array_of_words_is_shuffled(spark, docs):
    """In the shuffled plan no exchange carries words or texts, whatever the benchmark's size."""
    from annofold.llm.decontaminate import benchmark_windows, shingle_places, window_shingles

    d, b = tables(spark, docs)
    keyed = d.selectExpr("doc_id", "xxhash64(text) AS row", "text AS t")
    shingles = window_shingles(benchmark_windows(b, 10), 5)
    places = shingle_places(keyed, shingles, 5, few=False, with_sizes=False)
    plan = places._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(h#" in line]
    assert exchanges
    node = places._jdf.queryExecution().sparkPlan()
    assert not any(t.dataType.typeName() in ("array", "string") for t in places.schema)
    assert "hw" not in str(node.output())


def test_long_and_repetitive_texts(spark):
    words = [f"t{k % 7}" for k in range(60_000)]
    item = " ".join(f"t{k % 7}" for k in range(12))
    d = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(f"u{k}" for k in range(60_000)) + " " + item), (1, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    for rows in (0, 200_000):
        got = {(r["doc_id"], r["n_words"]): r["n_hit"] for r in contamination(d, b, broadcast_rows=rows)[0].collect()}
        assert got == {(1, 60_000): 60_000, (2, 60_012): 12, (1, 0): 0}
