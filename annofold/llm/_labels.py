"""Labelled rows for the two classifiers, without leaking the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a fit uses at most, about: a documented bound.
FIT_ROWS = 20_000


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; a null id counts as fold of the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def fit_sample(docs: DataFrame, labels: DataFrame, target: str, folds: int, held_out: int, bound: int = FIT_ROWS) -> DataFrame:
    """(text, y) of labelled documents outside the held-out fold, about ``bound`` at most.

    All of them up to the bound; beyond it those with the lowest share of a hash of doc_id.
    One row per doc_id: of several labels the largest, of several texts the smallest. Null
    labels and ids are left out. The labels, which the bound keeps few, go to the texts by a
    broadcast; no text is shuffled but the chosen ones.
    """
    known = labels.select(F.col("doc_id").alias("label_doc"), F.col(target).cast("int").alias("y"))
    known = known.filter("label_doc IS NOT NULL AND y IS NOT NULL").filter(fold_of(F.col("label_doc"), folds) != held_out)
    known = known.groupBy("label_doc").agg(F.max("y").alias("y"))
    n = known.count()
    if n > bound:
        known = known.filter(F.pmod(F.xxhash64("label_doc"), F.lit(1_000_000)) < int(1_000_000 * bound / n))
    texts = docs.select(F.col("doc_id").alias("text_doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    both = texts.join(F.broadcast(known), F.col("text_doc") == F.col("label_doc"))
    return both.groupBy("label_doc").agg(F.min("text").alias("text"), F.max("y").alias("y")).select("text", "y")
