"""Filter interaction audit by inclusion-exclusion.

How much does each quality filter remove, in whatever order the filters run? No order is
replayed on documents:

1. A document's failures are 0/1 flags. For each of the 32 sets S of the five filters, the
   joint-failure count N(S) is the sum over documents of the product of the flags of S;
   N of the empty set counts all. One aggregation sums all of them, for each part and for
   all, good and toxic documents.
2. Möbius inversion gives what is left: after the filters of F survive
   sum of (-1)^|S| N(S) over S within F; only f fails in sum of (-1)^(|S|-1) N(S) over S with f.
3. The removals form a cooperative game v(F) = N() - survivors(F), whose Harsanyi dividends
   are (-1)^(|S|+1) N(S). A filter's Shapley value is the sum of dividend / |S| over the sets
   that hold it; times 120 it is the filter's removals summed over all orders.
4. A step of an order is a difference of two survivor counts, so the 120 orders cost nothing
   but rows of the result.

Texts are read once, in Arrow batches, and never shuffled: their flags and a digest go on.
All else is DataFrame functions. Of equal texts only counts and the smallest doc_id go on,
combined before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annofold.llm._shared import tidy, utf8_column

FILTERS = "ABCDE"
SETS = range(1 << len(FILTERS))
_ORDERS = ["".join(p) for p in permutations(FILTERS)]
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"
#: Bytes of UTF-8 that do not begin a code point.
_CONTINUES = bytes(range(0x80, 0xC0))
#: What the joint-failure counts are taken of: column prefix and weight of a row.
_KINDS = ("n", "good", "toxic")


def text_failures(text: bytes) -> tuple[bool, bool, bool, bool]:
    """Whether a UTF-8 text fails A (few words), B (few distinct words), C (capitals), D (symbols)."""
    words = text.split()  # bytes split at [\x20\x09-\x0D] only
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUES))
    return len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * capitals > 10 * points, len(text.translate(None, _SYMBOLS)) < len(text)


def document_flags(docs: DataFrame) -> DataFrame:
    """(doc_id, part, a, b, c, d, digest) for each document: failures of the filters that look at one text alone, as 0/1."""
    chosen = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = utf8_column(batch, 2)
            failed = np.array([text_failures(t) for t in texts], np.int32).reshape(len(texts), 4)
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            flags = [pa.array(failed[:, k]) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *flags, digests], ["doc_id", "part", *"abcd", "digest"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(tidy(run), f"doc_id {kind}, part string, a int, b int, c int, d int, digest binary")


def _label_flags(labels: DataFrame) -> DataFrame:
    """(label_doc, good, toxic) as 0/1, one row a document: 1 if any row of its labels says so."""
    said = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("label_doc"))
    one = lambda c: F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("int"))
    return said.agg(one("quality").alias("good"), one("toxic").alias("toxic")).filter("good + toxic > 0")


def joint_failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, n_0..n_31, good_0..good_31, toxic_0..toxic_31): N(S) of each set S of filters, filter k of S at bit k."""
    keys = ["digest", "part", "a", "b", "c", "d"]
    copies = document_flags(docs).groupBy("doc_id", *keys).agg(F.count(F.lit(1)).alias("times"))
    known = copies.join(_label_flags(labels), F.col("doc_id") == F.col("label_doc"), "left")
    known = known.withColumns({k: F.coalesce(k, F.lit(0)) for k in ("good", "toxic")})
    # Filter E: all but the rows with the smallest doc_id of a text, and those without an id.
    alike = known.groupBy(*keys, "good", "toxic").agg(
        F.sum("times").alias("times"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("times")).otherwise(0)).alias("nameless"),
        F.min("doc_id").alias("least"),
        F.min_by("times", "doc_id").alias("least_times"),
    )
    first = F.min("least").over(Window.partitionBy("digest"))
    firsts = F.when(F.col("least") == F.col("first"), F.col("least_times")).otherwise(0)
    counted = alike.withColumn("first", first).withColumn("repeats", F.col("times") - F.col("nameless") - firsts)
    weights = {"n": "1", "good": "good", "toxic": "toxic"}
    sums = []
    for kind in _KINDS:
        for s in SETS:
            flags = [k for at, k in enumerate("abcd") if s >> at & 1]
            rows = "repeats" if s >> FILTERS.index("E") & 1 else "times"
            sums.append(F.expr(f"sum({' * '.join([rows, *flags, weights[kind]])})").alias(f"{kind}_{s}"))
    return counted.groupBy("part").agg(*sums)


def _combined(kind: str, factor: Callable[[int], int], sets: Iterable[int]) -> str:
    """SQL of the sum of factor(size of S) * N(S)."""
    return " + ".join(f"({factor(s.bit_count())}) * {kind}_{s}" for s in sets)


def _survivors(kind: str) -> Column:
    """Array over all sets F of filters: documents that fail none of F."""
    left = (_combined(kind, lambda size: (-1) ** size, (s for s in SETS if s & ~f == 0)) for f in SETS)
    return F.expr(f"array({', '.join(left)})")


def _by_filter(factor: Callable[[int], int]) -> Column:
    """Array over the filters: sum of factor(size of S) * N(S) over the sets S that hold the filter."""
    sums = (_combined("n", factor, (s for s in SETS if s >> k & 1)) for k in range(len(FILTERS)))
    return F.expr(f"array({', '.join(sums)})")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, with counts of documents.

    ``docs`` (doc_id, text, lang), ``labels`` (doc_id, quality, toxic). Columns: part,
    filter_order, step (1 to 5), kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley. A part is a lang value; null counts as the empty string. A null text
    is empty. Every row of ``docs`` counts, repeated ones too. Equal texts are found by their
    SHA-256: a row fails filter E if a smaller doc_id has its text, so rows that share the
    smallest doc_id, and rows without a doc_id, never do. A document is good or toxic if any
    row of its labels says 1; null labels and label rows without a document count nothing. An
    empty table has no part and gives no rows. Columns beside those named are not read.
    """
    counts = joint_failures(docs, labels)
    tables = counts.select(
        "part",
        *(_survivors(kind).alias(kind) for kind in _KINDS),
        F.array(*(F.col(f"n_{1 << k}") for k in range(len(FILTERS)))).alias("failing"),
        _by_filter(lambda size: (-1) ** (size - 1)).alias("alone"),
        _by_filter(lambda size: (-1) ** (size - 1) * len(_ORDERS) // size).alias("shapley"),
    )
    steps = tables.withColumn("filter_order", F.explode(F.lit(_ORDERS))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bits = lambda n: reduce(
        lambda x, y: x + y,
        (F.when(F.locate(f, F.substring("filter_order", F.lit(1), n)) > 0, 1 << k).otherwise(0) for k, f in enumerate(FILTERS)),
    )
    placed = steps.select(
        "*",
        bits(F.col("step") - 1).alias("before"),
        bits(F.col("step")).alias("after"),
        (F.instr(F.lit(FILTERS), F.substring("filter_order", F.col("step"), F.lit(1))) - 1).alias("at"),
    )
    lost = lambda kind: F.get(kind, F.col("before")) - F.get(kind, F.col("after"))
    return placed.select(
        "part",
        "filter_order",
        "step",
        F.get("n", F.col("after")).alias("kept"),
        lost("n").alias("removed"),
        (F.get("failing", F.col("at")) - lost("n")).alias("redundant"),
        F.get("alone", F.col("at")).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("shapley", F.col("at")).alias("shapley"),
    )
