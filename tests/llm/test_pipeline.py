from __future__ import annotations

import random

import pytest
from data import DOC_DDL, edited, prose

import corpus_pipeline
from annofold.llm.quality_rules import LineRules, judge


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    path = tmp_path_factory.mktemp("corpus")
    line = lambda n: prose(rng, n).capitalize() + "."
    item = prose(rng, 25)
    rows = []
    for k in range(40):
        rows.append((k, "\n".join([line(40), "Shared by many sites, word for word.", line(40)]), "en", f"s{k}", 1))
    base = line(100)
    rows += [(100 + k, edited(rng, base, k % 2).capitalize() + ".", "en", "s", 1) for k in range(6)]
    rows += [(200, f"{line(40)} {item}. {line(40)}", "en", "s", 1), (201, "too short.", "en", "s", 1), (202, None, "en", "s", 1)]
    rows += [(300, line(60) + "\nHome | News | About | Contact\n" + line(60), None, None, None)]
    spark.createDataFrame(rows, DOC_DDL).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, item


def test_stages(spark, folder):
    path, rows, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "packing"]
    held, texts = docs, {}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        held = stage(spark, held, path)
        assert held.columns == docs.columns
        held.write.parquet(f"{path}/stage{at}")
        held = spark.read.parquet(f"{path}/stage{at}")
        texts[name] = {r["doc_id"]: r["text"] for r in held.collect()}
    judged = {r[0]: judge(r[1].encode() if r[1] else None, LineRules()) for r in rows}
    assert texts["quality_rules"] == {d: j[9].decode() for d, j in judged.items() if j[6]}
    assert texts["quality_rules"].keys() == {*range(40), *range(100, 106), 200, 300}
    shared = "Shared by many sites, word for word."
    assert [d for d, t in texts["line_dedup"].items() if shared in t] == [0]
    assert texts["near_duplicates"].keys() == texts["line_dedup"].keys() - set(range(101, 106))
    assert texts["decontamination"].keys() == texts["near_duplicates"].keys() - {200}
    pieces = corpus_pipeline.STAGES[-1][1](spark, held, path)
    assert {r["doc_id"] for r in pieces.collect()} == set(texts["decontamination"])
    whole = corpus_pipeline.run(spark, path)
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    assert sorted(tuple(r[k] for k in key) for r in whole.collect()) == sorted(tuple(r[k] for k in key) for r in pieces.collect())


def test_near_duplicates_without_unique_ids(spark):
    rng = random.Random(5)
    a, b, c, own, lone = (prose(rng, 60) for _ in range(5))
    rows = [
        (1, a, "en", "s", 1),
        (5, own, "en", "s", 1),  # shares its id with a copy of 1, but is like no other text
        (5, a + " more", "en", "s", 1),
        (7, b, "en", "s", 2),  # one row three times, with two values beside
        (7, b, "en", "s", 1),
        (7, b, "en", "s", 2),
        (None, b + " more", "en", "s", 1),  # a copy of 7
        (None, c, "en", "s", 1),  # copies without any id
        (None, c, "en", "s", 1),
        (None, c + " more", "en", "s", 1),
        (None, lone, "en", "s", 1),
        (8, None, "en", "s", 1),
        (8, None, "en", "s", 1),
        (8, "", "en", "s", 1),
        (9, "", "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, DOC_DDL)
    got = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    of_c = [r for r in got if r[1] in (c, c + " more")]
    assert len(of_c) == 1 and of_c[0][0] is None
    want = [(1, a), (5, own), (7, b), (None, lone), (8, None), (8, ""), (9, "")]
    assert sorted(((r[0], r[1]) for r in got if r not in of_c), key=repr) == sorted(want, key=repr)
    assert (7, b, "en", "s", 1) in got


def test_empty_repeated_and_clashing(spark, folder, tmp_path):
    """Every stage takes an empty table, repeated rows, and columns with names that stages use."""
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    clashing = ("row", "k_doc", "k_row", "d_doc", "d_row", "whole", "carried", "component_id", "n", "at", "length", "hit_doc", "a.b")
    odd = docs.selectExpr("*", *(f"doc_id % 3 AS `{c}`" for c in clashing))
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        plain = stage(spark, docs, path)
        assert stage(spark, docs.limit(0), path).count() == 0
        got = stage(spark, odd, path)
        assert got.columns == odd.columns
        key = lambda df: sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=repr)
        assert key(got) == key(plain)
        twice = key(stage(spark, docs.union(docs), path))
        if name == "near_duplicates":
            assert twice == key(plain)  # of equal rows one stays
        else:
            assert set(twice) == set(key(plain))
    assert corpus_pipeline.packing(spark, docs.limit(0), path).count() == 0
    assert corpus_pipeline.packing(spark, odd, path).select("doc_id").distinct().count() == len(rows)
    spark.createDataFrame([], DOC_DDL).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
