"""The corpus pipeline: five operators of the ``llm`` subpackage in a row.

Each stage takes the whole output of the one before, written as Parquet and read again, and
returns the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annofold.llm._shared import broadcast_if_small, durable
from annofold.llm.decontaminate import contamination
from annofold.llm.line_spread import remove_spread_lines
from annofold.llm.packing import pack_documents
from annofold.llm.parity_join import similarity_components
from annofold.llm.quality_rules import keep_clean
from annofold.llm.queries import tokenizer_path
from annofold.operators.ranks import with_row_index


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go, and documents that are rejected."""
    return keep_clean(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found on many sites go, but for the first occurrence; every document stays."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    clean = remove_spread_lines(docs, carry=[f"`{c}`" for c in others])
    columns = {
        "doc_id": F.col("doc_id"),
        "text": F.col("clean_text"),
        "n_chars": F.length("clean_text").cast("long"),
        **{c: F.col(f"carried.`{c}`") for c in others},
    }
    return clean.select(*(columns[c].alias(c) for c in docs.columns))


def _keyed(docs: DataFrame) -> DataFrame:
    """(d_doc, d_row, whole): doc_id, hash of text, and the whole row, so that no name of a
    further column can meet one that a stage makes."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return docs.select(F.col("doc_id").alias("d_doc"), F.xxhash64(F.col("text").cast("string")).alias("d_row"), row.alias("whole"))


def _at_keys(keyed: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``keyed`` joined to ``keys`` (k_doc, k_row, ...): doc_id, which may be null, and hash of text."""
    same = F.col("d_doc").eqNullSafe(F.col("k_doc")) & (F.col("d_row") == F.col("k_row"))
    return keyed.join(broadcast_if_small(keys), same, how)


def _one_of_each(docs: DataFrame) -> DataFrame:
    """Of the rows with one doc_id (or none) and one text, the smallest by the other columns."""
    keyed = _keyed(docs)
    counts = keyed.groupBy(F.col("d_doc").alias("k_doc"), F.col("d_row").alias("k_row")).agg(F.count(F.lit(1)).alias("n"))
    repeated = durable(counts.filter("n > 1").select("k_doc", "k_row"))
    if repeated.isEmpty():
        return docs
    firsts = _at_keys(keyed, repeated, "left_semi").groupBy("d_doc", "d_row").agg(F.min("whole").alias("whole"))
    return durable(_at_keys(keyed, repeated, "left_anti").select("whole").union(firsts.select("whole")).select("whole.*"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts stays: the one with the smallest doc_id.

    A document is a doc_id with a text: rows that share a doc_id with different texts are
    judged each by its own, and of those in one group the one with the smallest hash of its
    text stays. Of rows that are equal in doc_id and text one stays, also without words. Rows
    without a doc_id take part and come last: one stays only in groups where no row has an id.
    Texts without words are similar to none. Further columns may have any name.
    """
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).filter("times > 1 OR doc_id IS NULL")
    if shared.isEmpty():
        others = similarity_components(docs).filter("doc_id != component_id").select(F.col("doc_id").alias("k_doc"))
        keyed = _keyed(docs)
        return keyed.join(broadcast_if_small(others), F.col("d_doc") == F.col("k_doc"), "left_anti").select("whole.*")
    docs = _one_of_each(docs)
    keyed = _keyed(docs)
    keys = keyed.select(F.col("d_doc").isNull().alias("no_id"), F.col("d_doc").alias("k_doc"), F.col("d_row").alias("k_row"))
    numbered = durable(with_row_index(keys, ["no_id", "k_doc", "k_row"], "k_number").drop("no_id"))
    texts = durable(_at_keys(keyed, numbered, "inner").select(F.col("k_number").alias("doc_id"), F.col("whole.text").alias("text")))
    others = similarity_components(texts).filter("doc_id != component_id").select(F.col("doc_id").alias("k_number"))
    return _at_keys(keyed, numbered.join(others, "k_number").select("k_doc", "k_row"), "left_anti").select("whole.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; rows that share a doc_id are judged each by its own text."""
    spans = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))[1]
    hit = spans.select(F.col("doc_id").alias("k_doc"), F.col("row").alias("k_row")).distinct()
    return _at_keys(_keyed(docs), hit, "left_anti").select("whole.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL has no tokenizer; tests/llm holds the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of the documents that all stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
