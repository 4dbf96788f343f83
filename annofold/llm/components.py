"""Connected components of an edge table: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annofold.llm._shared import durable


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step on (u, v): every node points the chosen neighbours at its smallest."""
    if larger:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).withColumnRenamed("u", "c")
    near = both.join(low, both.u == low.c)
    moved = near.filter("v > u" if larger else "v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not larger:
        moved = moved.union(low.filter("c != m").select("c", "m"))
    return moved.filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node of the component, for every node of ``edges`` (u, v).

    Node ids of any orderable type. Self-loops alone and null ends give no row; repeated
    edges do no harm; no edges give no rows. The number of rounds grows with the logarithm
    of the longest path; each round is written to the shared folder, and only counts reach
    the driver. A node of any degree is handled by a partial aggregation and a join.
    """
    pairs = edges.select("u", "v").filter("u IS NOT NULL AND v IS NOT NULL AND u != v").distinct()
    current, size = durable(pairs), -1
    while True:
        step = durable(_stars(_stars(current, larger=True), larger=False))
        # Both are sets, so they are equal when one holds no row that the other lacks and
        # their sizes agree; most rounds differ in size and need no comparison.
        now = step.count()
        same = now == size and step.join(current, ["u", "v"], "left_anti").isEmpty()
        current, size = step, now
        if same:
            break
    # Stable: every edge leads from a node to the smallest of its component.
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
