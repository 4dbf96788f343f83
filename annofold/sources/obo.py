"""Ontology files in OBO format. Ids: SRC-07, SRC-08."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _values(key: str) -> Column:
    """All values of a key of a stanza, in order."""
    mark = f"{key}: "
    mine = F.filter("lines", lambda x: x.startswith(mark))
    return F.transform(mine, lambda x: F.trim(F.substring(x, F.lit(len(mark) + 1), F.length(x))))


def _last(values: Column) -> Column:
    return F.coalesce(F.try_element_at(values, F.lit(-1)), F.lit(""))


def _parent(values: Column, relation: str, at: int) -> Column:
    """Structs (parent_term, relation): the word at place ``at`` of each value, which must be there."""
    return F.transform(
        values,
        lambda x: F.struct(
            F.coalesce(
                F.get(F.split(x, r"\s+"), F.lit(at)),
                F.raise_error(F.concat(F.lit("cannot read a parent from: "), x)).cast("string"),
            ).alias("parent_term"),
            F.lit(relation).alias("relation"),
        ),
    )


def obo(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(stanzas, edges) of the terms of an OBO file.

    stanzas: term, name, namespace, is_obsolete, alt_ids. edges: child_term, parent_term,
    relation (``is_a`` and ``part_of``). A stanza is one row of a text scan; of a repeated
    key the last value holds; a term without an id fails the query.
    """
    read = spark.read.option("lineSep", "\n[").text(path)
    rows = read.select(F.split(F.regexp_replace("value", r"\r\n?", "\n"), "\n").alias("raw"))
    head = F.regexp_replace(F.trim(F.get("raw", F.lit(0))), r"^\[", "")
    lines = rows.filter(head == "Term]").select(F.transform("raw", lambda x: F.trim(x)).alias("lines"))
    term = _last(_values("id"))
    told = F.raise_error(F.lit("a term without an id")).cast("string")
    # The guard says itself which stanzas are terms: filters on the id may be tried before the one above.
    lacking = (term == "") & (F.regexp_replace(F.get("lines", F.lit(0)), r"^\[", "") == "Term]")
    part_of = F.filter(_values("relationship"), lambda x: x.startswith("part_of "))
    parsed = lines.select(
        F.when(lacking, told).otherwise(term).alias("term"),
        _last(_values("name")).alias("name"),
        _last(_values("namespace")).alias("namespace"),
        (F.lower(_last(_values("is_obsolete"))) == "true").alias("is_obsolete"),
        _values("alt_id").alias("alt_ids"),
        F.concat(_parent(_values("is_a"), "is_a", 0), _parent(part_of, "part_of", 1)).alias("parents"),
    )
    edges = parsed.select(F.col("term").alias("child_term"), F.explode("parents").alias("p")).select(
        "child_term", "p.parent_term", "p.relation"
    )
    return parsed.drop("parents"), edges
