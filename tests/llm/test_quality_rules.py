from __future__ import annotations

from annofold.llm.quality_rules import keep_clean, line_first_quality
from annofold.llm.queries import ORACLE_SQL

GOOD = " ".join(f"the{k} word{k} number{k} stands{k} here{k}." for k in range(14))


def test_equals_sql_on_odd_texts(spark, docs, duck):
    extra = spark.createDataFrame(
        [
            (900, f"{GOOD}\nHome | About | News | Contact\n{GOOD[:200]}.\nALL CAPS LINE HERE.\nAll Rights Reserved.\n\n#$% a.", "en", "s", 1),
            (901, GOOD + "\n" + GOOD, "en", "s", 1),
            (902, "Menu | a | b | c\n" * 60, "en", "s", 1),
            (903, "\x0bx\x0c y.\n" * 30 + "é…\n", "en", "s", 1),
        ],
        docs.schema,
    )
    both = docs.union(extra)
    got = line_first_quality(both)
    want = duck(ORACLE_SQL["op2_quality_rules"], got.columns, documents=both.toPandas())
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_rules_take_effect(spark):
    text = f"{GOOD}\nHome | About | News | Contact\nThis line is licensed under a licence.\n{GOOD}"
    df = spark.createDataFrame([(1, text, 5, "x"), (2, "short", 5, "x"), (3, None, 5, "x")], "doc_id long, text string, n_chars long, lang string")
    # The first repeats all its words, the second is short, the third has none.
    assert keep_clean(df).count() == 0
    once = spark.createDataFrame([(1, text.rsplit("\n", 1)[0], 5, "x")], df.schema)
    row = keep_clean(once).first()
    assert row["text"] == GOOD and row["n_chars"] == len(GOOD) and row["lang"] == "x"
    judged = line_first_quality(once, with_text=True).first()
    assert (judged["n_lines"], judged["n_bad_lines"], judged["kept"], judged["clean_text"]) == (3, 2, True, GOOD)


def test_empty_and_clashing(docs, clashing):
    assert line_first_quality(docs.limit(0)).count() == 0
    assert line_first_quality(clashing).count() == docs.count()
    assert set(keep_clean(clashing).columns) == set(clashing.columns)


def test_every_script_closes_its_sentences(spark, docs, duck):
    """Lines that end as their script does are kept; furniture of other languages goes."""
    chinese = "\n".join(" ".join(f"河{k}边{j}" for j in range(10)) + "。" for k in range(20))
    hindi = "\n".join(" ".join(f"घर{k}नदी{j}" for j in range(10)) + "।" for k in range(20))
    arabic = "\n".join(" ".join(f"بيت{k}نهر{j}" for j in range(10)) + "؟" for k in range(20))
    french = GOOD + "\nTous droits réservés - mentions légales.\n"
    german = GOOD + "\nAlle Rechte vorbehalten. Impressum.\n"
    rows = [(k, t, "xx", "s", 1) for k, t in enumerate([chinese, hindi, arabic, french, german])]
    table = spark.createDataFrame(rows, docs.schema)
    got = line_first_quality(table)
    found = {r["doc_id"]: (r["kept"], r["n_bad_lines"]) for r in got.collect()}
    assert found == {0: (True, 0), 1: (True, 0), 2: (True, 0), 3: (True, 1), 4: (True, 1)}
    want = duck(ORACLE_SQL["op2_quality_rules"], got.columns, documents=table.toPandas())
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
