from __future__ import annotations

from annofold.llm.line_spread import remove_spread_lines
from annofold.llm.queries import ORACLE_SQL, op7_line_spread  # noqa: F401
from pyspark.sql import functions as F


def digests(out):
    return out.select(
        "doc_id", "n_lines", "n_removed", F.coalesce(F.length("clean_text"), F.lit(0)).cast("long").alias("n_chars"), F.md5(F.coalesce("clean_text", F.lit(""))).alias("text_md5")
    )


def pages():
    rows = []
    for k in range(60):
        lines = [f"own line {k}", "  shared by all \t", "by seven" if k % 20 < 7 else f"z {k}", "by eight" if k % 20 < 8 else f"y {k}", ""]
        rows.append((k, "\n".join(lines), "en", f"site{k % 20}", 1))
    rows += [(100, None, "en", "a", 1), (101, "", "en", "b", 1), (102, "shared by all", "en", None, 1), (103, "shared by all\nshared by all", "en", "c", 1)]
    return rows


def test_threshold_is_exact(spark, docs, duck):
    df = spark.createDataFrame(pages(), docs.schema)
    got = digests(remove_spread_lines(df))
    want = duck(ORACLE_SQL["op7_line_spread"], got.columns, documents=df.toPandas())
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    out = {r["doc_id"]: r for r in remove_spread_lines(df).collect()}
    assert out[0]["n_removed"] == 0, "the first occurrence of each line stays"
    assert "by seven" in out[1]["clean_text"] and "by eight" not in out[1]["clean_text"]
    assert out[100]["clean_text"] is None and out[102]["clean_text"] == "" and out[103]["n_removed"] == 2


def test_sketches_and_exact_counts_agree(spark, docs):
    df = spark.createDataFrame([(k, f"line {k % 40}", "en", f"s{k % (k % 40 + 1)}", 1) for k in range(4000)], docs.schema)
    wide, narrow = (remove_spread_lines(df, 15, m).select("doc_id", "n_removed") for m in (10.0, 0.1))
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, narrow.collect()))


def test_odd_tables(spark, docs, clashing, duck):
    got = digests(remove_spread_lines(clashing, 3))
    want = duck(ORACLE_SQL["op7_line_spread"].replace(">= 8", ">= 3"), got.columns, documents=docs.toPandas())
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert remove_spread_lines(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a\nb", "en", f"s{k}", 1) for k in range(9)], docs.schema)
    assert [r["clean_text"] for r in remove_spread_lines(twice).collect()] == ["a\nb"] * 9
    carried = remove_spread_lines(docs, carry=["lang", "n_chars"])
    assert carried.select("carried.lang").distinct().count() == 1
