"""Ontology tables: terms, edges, ancestor closure, and labels closed over it.

Ids: PRJ-12..15, REC-01, AGG-08, AGG-20, AGG-22, DOM-05, DOM-06, JOI-08..10, SET-01.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annofold.schemas import BRANCH_TO_ASPECT, NAMESPACE_TO_BRANCH, RELATIONS, fail_if_any, mapped, require_columns
from annofold.storage import broadcast_if_small, dealt, settled_with

# Reasons for which an edge is left out, in the order in which they are tried.
DROP_REASONS = ("relation", "unknown_child", "unknown_parent", "unknown_branch", "cross_branch")


@dataclass(frozen=True)
class OntologyTables:
    """Active terms, kept edges, ancestors, alternative ids, and all parsed terms."""

    terms: DataFrame
    edges: DataFrame
    ancestors: DataFrame
    alt_ids: DataFrame
    all_terms: DataFrame
    edge_drops: DataFrame


def term_table(stanzas: DataFrame) -> DataFrame:
    """(term, name, namespace, branch, is_obsolete, alt_ids, n_alt_ids) from parsed stanzas."""
    return stanzas.select(
        "term",
        "name",
        "namespace",
        mapped(F.col("namespace"), NAMESPACE_TO_BRANCH).alias("branch"),
        "is_obsolete",
        F.array_sort(F.array_distinct("alt_ids")).alias("alt_ids"),
        F.size(F.array_distinct("alt_ids")).alias("n_alt_ids"),
    )


def active_terms(terms: DataFrame) -> DataFrame:
    """Terms that are not obsolete and have a branch."""
    return terms.filter(~F.col("is_obsolete") & F.col("branch").isNotNull())


def alt_id_table(terms: DataFrame, validate: bool = True) -> DataFrame:
    """(alt_id, term) of active terms; ``validate`` fails on an alternative id of several terms."""
    out = terms.select(F.explode("alt_ids").alias("alt_id"), "term").filter("alt_id != ''")
    if validate:
        fail_if_any(out.groupBy("alt_id").count().filter("count > 1"), "alternative ids of several terms", "alt_id")
    return out


def classify_edges(raw_edges: DataFrame, terms: DataFrame, relations: Sequence[str] = RELATIONS) -> DataFrame:
    """``raw_edges`` (child_term, parent_term, relation) with both branches and ``drop_reason``.

    The reason is the first of ``DROP_REASONS`` that applies, or null for an edge to keep.
    """
    known = terms.select("term", "branch")
    child = known.select(F.col("term").alias("c"), F.col("branch").alias("child_branch"))
    parent = known.select(F.col("term").alias("p"), F.col("branch").alias("parent_branch"))
    both = raw_edges.join(child, F.col("child_term") == F.col("c"), "left").join(
        parent, F.col("parent_term") == F.col("p"), "left"
    )
    tests = (
        ~F.col("relation").isin(*relations),
        F.col("c").isNull(),
        F.col("p").isNull(),
        F.col("child_branch").isNull() | F.col("parent_branch").isNull(),
        F.col("child_branch") != F.col("parent_branch"),
    )
    reason = F.coalesce(*(F.when(t, F.lit(name)) for t, name in zip(tests, DROP_REASONS, strict=True)))
    return both.select("child_term", "parent_term", "relation", "child_branch", "parent_branch", reason.alias("drop_reason"))


def kept_edges(classified: DataFrame) -> DataFrame:
    """Distinct edges without a drop reason."""
    return classified.filter("drop_reason IS NULL").drop("drop_reason").dropDuplicates()


def edge_drop_counts(classified: DataFrame) -> DataFrame:
    """(drop_reason, n) with ``kept`` for the rest, rows counted before duplicates go."""
    return classified.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class ClosureRound:
    """One round of the closure: rows of the last round's edge that it joined, and pairs that it added."""

    joined: int
    added: int


def closure(edges: DataFrame) -> tuple[DataFrame, list[ClosureRound]]:
    """(term, ancestor, distance), the shortest distance to every ancestor, and the rounds that it took.

    Semi-naive path doubling. After r rounds every pair at a distance of at most 2^r is known
    exactly. A pair at a distance of 2^r < d <= 2^(r+1) is a pair at a distance of exactly 2^r,
    followed by a known one. So a round joins the rows at that one distance with the table,
    and what it finds beside known pairs is final: nothing is shortened or written again.
    Depth d takes log2(d) + 1 rounds, each one job that writes its new rows to the shared folder and
    counts those at its edge. A term on a cycle is no ancestor of itself.
    """
    near = edges.filter("child_term != parent_term").select(
        F.col("child_term").alias("term"), F.col("parent_term").alias("ancestor"), F.lit(1).alias("distance")
    )
    step, rounds = 1, []
    at_edge = lambda d: (F.count(F.lit(1)).alias("n"), F.count_if(F.col("distance") == d).alias("edge"))
    reach, now = settled_with(near.dropDuplicates(), *at_edge(step))
    while now["edge"]:
        edge = reach.filter(F.col("distance") == step).select("term", F.col("ancestor").alias("mid"))
        far = reach.select(F.col("term").alias("from"), F.col("ancestor"), F.col("distance").alias("more"))
        longer = edge.join(far, F.col("mid") == F.col("from")).filter("term != ancestor")
        shortest = longer.groupBy("term", "ancestor").agg((F.min("more") + step).alias("distance"))
        joined = now["edge"]
        step *= 2
        new, now = settled_with(shortest.join(reach, ["term", "ancestor"], "left_anti"), *at_edge(step))
        rounds.append(ClosureRound(joined, now["n"]))
        reach = reach.unionByName(new)
    return reach, rounds


def ancestor_table(terms: DataFrame, edges: DataFrame) -> DataFrame:
    """(term, ancestor, distance, term_branch, ancestor_branch): shortest distance to every ancestor."""
    known = terms.select("term", "branch")
    return (
        closure(edges)[0].join(known.select("term", F.col("branch").alias("term_branch")), "term")
        .join(known.select(F.col("term").alias("ancestor"), F.col("branch").alias("ancestor_branch")), "ancestor")
        .select("term", "ancestor", "distance", "term_branch", "ancestor_branch")
    )


def build_ontology(
    stanzas: DataFrame, raw_edges: DataFrame, relations: Sequence[str] = RELATIONS, validate: bool = True
) -> OntologyTables:
    """All ontology tables from parsed stanzas and edges."""
    all_terms = term_table(stanzas)
    terms = active_terms(all_terms)
    classified = classify_edges(raw_edges, terms, relations)
    edges = kept_edges(classified)
    return OntologyTables(
        terms=terms,
        edges=edges,
        ancestors=ancestor_table(terms, edges),
        alt_ids=alt_id_table(terms, validate),
        all_terms=all_terms,
        edge_drops=edge_drop_counts(classified),
    )


def resolve_terms(labels: DataFrame, terms: DataFrame, alt_ids: DataFrame) -> DataFrame:
    """``labels`` with canonical_term and its ontology_branch: the term itself if active, else by alternative id, else null."""
    active = terms.select(F.col("term").alias("active"), F.col("branch").alias("active_branch"))
    other = alt_ids.select("alt_id", F.col("term").alias("alt_term")).join(
        terms.select(F.col("term").alias("alt_term"), F.col("branch").alias("alt_branch")), "alt_term"
    )
    return (
        labels.join(active, F.col("term") == F.col("active"), "left")
        .join(other, F.col("term") == F.col("alt_id"), "left")
        .withColumn("canonical_term", F.coalesce("active", "alt_term"))
        .withColumn("ontology_branch", F.coalesce("active_branch", "alt_branch"))
        .drop("active", "active_branch", "alt_id", "alt_term", "alt_branch")
    )


def closed_terms(terms: DataFrame, ancestors: DataFrame, alt_ids: DataFrame) -> DataFrame:
    """(source_term, closed, closed_branch, is_direct, distance): what a label term stands for.

    That is an active term itself, or the term of an alternative id that is no active term,
    and all its ancestors. One row a pair, as many as the ontology has, not as labels have.
    """
    active = terms.select(F.col("term").alias("source_term"), F.col("term").alias("canonical"))
    other = alt_ids.select(F.col("alt_id").alias("source_term"), F.col("term").alias("canonical"))
    other = other.join(active.select("source_term"), "source_term", "left_anti")
    own = terms.select(F.col("term").alias("child"), F.col("term").alias("closed"), F.lit(0).alias("distance"), F.col("branch").alias("closed_branch"))
    up = ancestors.select(F.col("term").alias("child"), F.col("ancestor").alias("closed"), "distance", F.col("ancestor_branch").alias("closed_branch"))
    both = active.unionByName(other).join(own.unionByName(up), F.col("canonical") == F.col("child")).filter("closed_branch IS NOT NULL")
    return both.groupBy("source_term", "closed", "closed_branch").agg(
        F.bool_or(F.col("canonical") == F.col("closed")).alias("is_direct"), F.min("distance").alias("distance")
    )


def close_labels(labels: DataFrame, terms: DataFrame, ancestors: DataFrame, alt_ids: DataFrame) -> DataFrame:
    """Direct labels and all their ancestors: (entry_id, term, aspect, branch, is_direct, distance, n_sources).

    The branch is the ontology's. Labels are dealt by entry, to tasks by their counted number, and
    the distinct ones meet the closed terms of their own in one join, so what the join makes is combined where it is made. A label
    reaches a closed term once, so rows are counted, not distinct sources.
    """
    require_columns(labels, ("entry_id", "term", "branch"), "labels")
    given = labels.select("entry_id", F.col("term").alias("source_term")).filter("entry_id IS NOT NULL")
    given = dealt(given, labels.count(), "entry_id").distinct()
    rows = given.join(broadcast_if_small(closed_terms(terms, ancestors, alt_ids)), "source_term")
    return rows.groupBy("entry_id", F.col("closed").alias("term"), F.col("closed_branch").alias("branch")).agg(
        F.bool_or("is_direct").alias("is_direct"), F.min("distance").alias("distance"), F.count(F.lit(1)).alias("n_sources")
    ).select(
        "entry_id",
        "term",
        mapped(F.col("branch"), BRANCH_TO_ASPECT).alias("aspect"),
        "branch",
        "is_direct",
        "distance",
        F.col("n_sources").cast("int").alias("n_sources"),
    )


def label_issues(labels: DataFrame, terms: DataFrame, alt_ids: DataFrame, all_terms: DataFrame) -> DataFrame:
    """Distinct (issue, term): ``alt_id``, ``obsolete``, ``missing`` and ``branch_mismatch`` label terms.

    A term that is known, not obsolete and without a branch is in no list.
    """
    resolved = resolve_terms(labels.select("term", "branch").distinct(), terms, alt_ids)
    known = all_terms.select(F.col("term").alias("known"), "is_obsolete").dropDuplicates(["known"])
    told = resolved.join(known, F.col("term") == F.col("known"), "left")
    unresolved = F.col("canonical_term").isNull()
    issues = F.array_compact(
        F.array(
            F.when(~unresolved & (F.col("term") != F.col("canonical_term")), F.lit("alt_id")),
            F.when(unresolved & F.col("is_obsolete"), F.lit("obsolete")),
            F.when(unresolved & F.col("known").isNull(), F.lit("missing")),
            F.when(~unresolved & ~F.col("branch").eqNullSafe(F.col("ontology_branch")), F.lit("branch_mismatch")),
        )
    )
    return told.select(F.explode(issues).alias("issue"), "term").filter("term IS NOT NULL").distinct()


def parents_of(edges: DataFrame) -> DataFrame:
    """(child_term, parents): the sorted distinct parents of each child."""
    return edges.groupBy("child_term").agg(F.array_sort(F.collect_set("parent_term")).alias("parents"))
