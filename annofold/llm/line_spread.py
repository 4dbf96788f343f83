"""Cross-site boilerplate lines by distinct-site spread.

1. One HyperLogLog sketch of sites per line hash; sketches merge in the aggregation, so a
   very common line costs one sketch per task. Two 64-bit hashes make the line key.
2. Lines whose estimate is clearly above ``min_sites`` are boilerplate; those within
   ``margin`` of it get exact distinct counts.
3. Every occurrence of a boilerplate line goes, except the first one of the corpus (smallest
   doc_id, then position), so that no text is lost altogether.

The threshold is one number for lines of any length: a line on fewer than ``min_sites`` sites
stays however many documents hold it, a long passage inside one or a few sites too, and a
table with fewer sites never loses a line.

DataFrame functions only. Line keys, never whole texts, are shuffled, until the documents
that lose lines get their flags.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annofold.llm._shared import durable

MIN_SITES = 8
#: Share of min_sites on either side that is counted exactly; a sketch of 2^12 registers has
#: a standard error of 1.6 %.
MARGIN = 0.1
LG_K = 12


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, r"^[ \t\r]+|[ \t\r]+$", "")


def line_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, row, site, at, h1, h2) of all lines; blank lines have null hashes."""
    chosen = docs.select(
        F.col("doc_id").alias("doc_id"), F.col("source").cast("string").alias("site"), F.col("text").cast("string").alias("t")
    )
    lines = chosen.select("doc_id", F.xxhash64("t").alias("row"), "site", F.posexplode(F.split("t", "\n")).alias("at", "line"))
    bare = lines.withColumn("line", _bare(F.col("line")))
    worded = F.col("line") != ""
    return bare.select(
        "doc_id",
        "row",
        "site",
        "at",
        F.when(worded, F.xxhash64("line")).alias("h1"),
        F.when(worded, F.xxhash64(F.lit("line"), F.col("line"))).alias("h2"),
    )


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """(h1, h2, first_doc, first_at) of the lines found on at least ``min_sites`` sites."""
    slack = max(1.0, margin * min_sites)
    worded = lines.filter("h1 IS NOT NULL")
    sketched = worded.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"))
    likely = durable(
        sketched.filter(F.col("sites") >= min_sites - slack).select("h1", "h2", (F.col("sites") < min_sites + slack).alias("near"))
    )
    exact = worded.join(likely, ["h1", "h2"]).groupBy("h1", "h2", "near").agg(
        F.count_distinct(F.when(F.col("near"), F.col("site"))).alias("sites"),
        F.min(F.struct("doc_id", "at")).alias("first"),
    )
    spread = exact.filter(~F.col("near") | (F.col("sites") >= min_sites))
    return spread.select("h1", "h2", F.col("first.doc_id").alias("first_doc"), F.col("first.at").alias("first_at"))


def remove_spread_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN, carry: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, n_lines, n_removed, clean_text, carried) for each row of ``docs`` (doc_id, source, text).

    ``carried`` is a struct of the columns named in ``carry``. A null text stays null and has no lines; blank lines
    are never removed or counted; a null source counts as no site; equal rows are treated
    alike (the first occurrence stays in each of them); a text that loses all lines becomes
    empty; an empty table gives none. Further columns are not read.
    """
    lines = line_keys(docs)
    spread = durable(spread_lines(lines, min_sites, margin))
    spread_key = spread.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "first_doc", "first_at")
    flagged = lines.join(spread_key, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    first = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("at") == F.col("first_at"))
    flags = (
        flagged.select("doc_id", "row", "at", (F.col("k1").isNotNull() & ~first).alias("gone"))
        .groupBy("doc_id", "row")
        .agg(F.array_sort(F.collect_set(F.struct("at", "gone"))).alias("flags"), F.max("gone").alias("any_gone"))
        .filter("any_gone")
        .select(F.col("doc_id").alias("f_doc"), F.col("row").alias("f_row"), F.col("flags.gone").alias("gone"))
    )
    carried = F.struct(*carry) if carry else F.lit(None).cast("string")
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("t"), carried.alias("carried"))
    texts = texts.withColumn("row", F.xxhash64("t"))
    both = texts.join(flags, F.col("doc_id").eqNullSafe(F.col("f_doc")) & (F.col("row") == F.col("f_row")), "left")
    split = F.split("t", "\n")
    clean = F.array_join(F.filter(split, lambda line, i: ~F.get("gone", i)), "\n")
    removed = F.size(F.filter("gone", lambda g: g))
    worded = F.size(F.filter(split, lambda line: _bare(line) != ""))
    return both.select(
        "doc_id",
        F.when(F.col("t").isNull(), 0).otherwise(worded).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(removed).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("t")).otherwise(clean).alias("clean_text"),
        "carried",
    )
