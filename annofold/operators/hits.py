"""Similarity hits: one schema, weights, leakage filters and label transfer.

Ids: PRJ-01..03, PRJ-06, DOM-01..04, WIN-01, WIN-04, AGG-03..05, AGG-16, JOI-01..05.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annofold.functions import as_fraction, clip_unit, number
from annofold.operators.predictions import prune_top_k
from annofold.operators.skew import CELL_ROWS, skew_join
from annofold.schemas import BRANCHES, HIT_COLUMNS, not_missing, require_columns, with_branch
from annofold.storage import broadcast_if_small, settled

# Accepted names of the hit columns, in order of preference.
HIT_ALIASES: dict[str, tuple[str, ...]] = {
    "query_id": ("query_id", "query", "qseqid", "qid", "query_entry_id"),
    "target_id": ("target_id", "target", "sseqid", "subject_id", "sid", "target_entry_id"),
    "score": ("score", "hit_score", "weight"),
    "bitscore": ("bitscore", "bits", "bit_score", "raw_score"),
    "evalue": ("evalue", "eval"),
    "pident": ("pident", "identity", "percent_identity"),
    "qcov": ("qcov", "qcovs", "qcovhsp", "qcovus", "query_coverage"),
    "tcov": ("tcov", "scov", "scovs", "target_coverage", "subject_coverage"),
}
#: -log10(evalue) that counts as a full weight, and the smallest evalue told apart from 0.
EVALUE_SCALE = 200.0
LEAST_EVALUE = 1e-300
#: Chance of a miss that even a perfect hit leaves.
LEAST_MISS = 1e-12
_QUOTED = "`{}`"


def first_present(columns: Sequence[str], aliases: Sequence[str]) -> str | None:
    """The column that matches the earliest alias, ignoring case."""
    by_name = {c.lower(): c for c in columns}
    return next((by_name[a.lower()] for a in aliases if a.lower() in by_name), None)


def normalize_hits(hits: DataFrame) -> DataFrame:
    """The eight standard hit columns of any hit table, without duplicates or rows lacking an id.

    Columns are found by ``HIT_ALIASES``; one that is absent, and any value that is no number,
    becomes null. Only those columns are read.
    """
    return _standard(hits).dropDuplicates()


def _standard(hits: DataFrame) -> DataFrame:
    found = {name: first_present(hits.columns, aliases) for name, aliases in HIT_ALIASES.items()}
    for name in ("query_id", "target_id"):
        if found[name] is None:
            raise ValueError(f"hits need a column for {name}")

    def read(name: str) -> Column:
        source = found[name]
        if name in ("query_id", "target_id"):
            return F.col(_QUOTED.format(source)).cast("string").alias(name)
        return (number(F.col(_QUOTED.format(source))) if source else F.lit(None).cast("double")).alias(name)

    out = hits.select(*(read(name) for name in HIT_COLUMNS))
    return out.filter("query_id IS NOT NULL AND query_id != '' AND target_id IS NOT NULL AND target_id != ''")


def _unit(column: Column) -> Column:
    """``clip_unit`` of a column without nulls, which it names once."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), column))


def exact_parts(column: Column) -> tuple[Column, Column]:
    """A double as two multiples of powers of two, whose sums are exact in any order.

    Multiples of 2^-26 add up exactly below 2^27, and the rests, multiples of 2^-66 below 2^-26,
    over 8,000 rows and more; beyond that the sums are as good as those of plain doubles. What is
    left out is less than 2^-66.
    """
    coarse = F.rint(column * 2.0**26) / 2.0**26
    return coarse, F.rint((column - coarse) * 2.0**66) / 2.0**66


#: Columns that weights can rest on, in order of preference.
BASES = ("score", "bitscore", "pident", "evalue")


def weight_basis(standard: DataFrame) -> str:
    """The first of ``BASES`` with any value in the whole table, or ``none``.

    Runs one narrow aggregation at once: the answer decides the plan, which then holds one
    base only and no join for the others.
    """
    counts = standard.agg(*(F.count(c).alias(c) for c in BASES)).first()
    return next((c for c in BASES if counts[c]), "none")


def add_hit_weights(hits: DataFrame, basis: str | None = None) -> DataFrame:
    """Standard hits plus ``hit_weight`` in (0, 1]; rows of weight 0 are left out.

    The base weight is the score itself, the bit score as a share of the query's best, the
    identity, or -log10(evalue) / 200, by the first of these columns that has any value in the
    table; without any it is 1. It is multiplied by the geometric mean of both coverages
    (absent: 1). A ``basis`` that the caller knows spares the look at the table.
    """
    standard = normalize_hits(hits)
    if basis is None:
        # Only columns that the table has can have values; duplicates do not matter here.
        named = any(first_present(hits.columns, HIT_ALIASES[c]) for c in BASES)
        basis = weight_basis(_standard(hits)) if named else "none"
    # Bases and coverage are never null, so they are limited by ``_unit``: each is stated once and the
    # filter on the weight stays a short expression, also where it is pushed below the distinct rows.
    if basis == "bitscore":
        # An aggregation and a join, not a window: a query with a very large share of the
        # hits is combined before the shuffle and can be split in the join. Duplicates do not
        # change a maximum, so it reads two columns of the table and not the distinct rows.
        best = _standard(hits).groupBy(F.col("query_id").alias("best_query")).agg(F.max("bitscore").alias("best"))
        standard = standard.join(best, F.col("query_id") == F.col("best_query"))
        base = F.when(F.col("best") > 0, F.coalesce(F.col("bitscore"), F.lit(0.0)) / F.col("best")).otherwise(0.0)
    elif basis == "score":
        base = F.coalesce("score", F.lit(0.0))
    elif basis == "pident":
        base = as_fraction(F.col("pident"), 0.0)
    elif basis == "evalue":
        base = -F.log10(F.greatest(F.coalesce("evalue", F.lit(1.0)), F.lit(LEAST_EVALUE))) / EVALUE_SCALE
    elif basis == "none":
        base = F.lit(1.0)
    else:
        raise ValueError(f"unknown basis of weights: {basis}")
    coverage = F.sqrt(as_fraction(F.col("qcov"), 1.0) * as_fraction(F.col("tcov"), 1.0))
    weighted = standard.withColumn("hit_weight", _unit(_unit(base) * coverage))
    return weighted.filter("hit_weight > 0").select(*HIT_COLUMNS, "hit_weight")


def filter_oof_hits(hits: DataFrame, folds: DataFrame) -> DataFrame:
    """Weighted hits between entries of different folds, with ``query_fold`` and ``target_fold``.

    Weights are made before anything is left out, so a query's best bit score counts hits on
    itself. Hits of entries without a fold go; an entry with several folds counts as one of
    the lowest, so it never meets a target of that fold.
    """
    require_columns(folds, ("entry_id", "fold"), "folds")
    known = folds.select(F.col("entry_id").cast("string").alias("fold_entry"), F.col("fold").cast("int").alias("fold_no"))
    known = broadcast_if_small(known.filter(not_missing("fold_entry", "fold_no")).groupBy("fold_entry").agg(F.min("fold_no").alias("fold_no")))
    of_query = known.select(F.col("fold_entry").alias("q_entry"), F.col("fold_no").alias("query_fold"))
    of_target = known.select(F.col("fold_entry").alias("t_entry"), F.col("fold_no").alias("target_fold"))
    return (
        add_hit_weights(hits)
        .join(of_query, F.col("query_id") == F.col("q_entry"))
        .join(of_target, F.col("target_id") == F.col("t_entry"))
        .filter("query_id != target_id AND query_fold != target_fold")
        .select(*HIT_COLUMNS, "hit_weight", "query_fold", "target_fold")
    )


def filter_test_hits(hits: DataFrame, labels: DataFrame, exclude_self: bool = True) -> DataFrame:
    """Weighted hits on labelled targets; by default without hits of an entry on itself."""
    labelled = prepare_labels(labels).select(F.col("entry_id").alias("target_id")).distinct()
    out = add_hit_weights(hits).join(labelled, "target_id", "left_semi").select(*HIT_COLUMNS, "hit_weight")
    return out.filter("query_id != target_id") if exclude_self else out


def prepare_labels(labels: DataFrame) -> DataFrame:
    """Distinct (entry_id, term, branch); the branch may come from an aspect column."""
    require_columns(labels, ("entry_id", "term"), "labels")
    out = with_branch(labels, "labels", strict=False).select(
        F.col("entry_id").cast("string").alias("entry_id"), F.col("term").cast("string").alias("term"), "branch"
    )
    return out.filter(not_missing("entry_id", "term", "branch")).dropDuplicates()


def limit_hits(hits: DataFrame, max_hits: int | None = 100) -> DataFrame:
    """The ``max_hits`` heaviest hits of each query; no limit for None or 0 and below.

    Ties go by target, then by all other columns, so the choice never depends on input order.
    """
    if not max_hits or max_hits <= 0:
        return hits
    rest = sorted(set(hits.columns) - {"query_id", "target_id", "hit_weight"})
    order = Window.partitionBy("query_id").orderBy(F.desc("hit_weight"), "target_id", *rest)
    return hits.withColumn("__at", F.row_number().over(order)).filter(F.col("__at") <= max_hits).drop("__at")


def aggregate_hit_labels(
    hits: DataFrame, labels: DataFrame, max_hits: int | None = 100, min_weight: float = 0.0, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Noisy-OR transfer: (entry_id, term, branch, score, n_hits, best_hit_weight).

    The score is 1 - prod(1 - weight) over the query's hits whose target has the label. Each
    row of a repeated (query, target) pair counts in the product, while n_hits counts
    targets. Logarithms are summed in exact parts, so labels of the same hits have the same score
    in whatever order rows come, and a cut of equal scores goes by term. The rows of a pair are combined before the join with labels, so the join and the
    last aggregation see each pair once. Targets that a large share of the hits has are dealt
    to several tasks (``skew_join``).
    """
    require_columns(hits, ("query_id", "target_id", "hit_weight"), "hits")
    weight = _unit(F.coalesce(number(F.col("hit_weight")), F.lit(0.0)))
    usable = hits.withColumn("hit_weight", weight).filter(F.col("hit_weight") > min_weight)
    missed = limit_hits(usable, max_hits).withColumn("miss", F.log(F.greatest(1.0 - F.col("hit_weight"), F.lit(LEAST_MISS))))
    coarse, fine = exact_parts(F.col("miss"))
    pairs = (
        missed
        .groupBy(F.col("query_id").cast("string").alias("query_id"), F.col("target_id").cast("string").alias("target_id"))
        .agg(F.sum(coarse).alias("coarse"), F.sum(fine).alias("fine"), F.max("hit_weight").alias("weight"))
    )
    carried = prepare_labels(labels).withColumnRenamed("entry_id", "target_id")
    return (
        skew_join(pairs, carried, "target_id", (("query_id",), ("term", "branch")), cell_rows)
        .groupBy(F.col("query_id").alias("entry_id"), "term", "branch")
        .agg((F.sum("coarse") + F.sum("fine")).alias("log_miss"), F.count(F.lit(1)).alias("n_hits"), F.max("weight").alias("best_hit_weight"))
        .select("entry_id", "term", "branch", clip_unit(1.0 - F.exp("log_miss")).alias("score"), "n_hits", "best_hit_weight")
    )


def oof_transfer(
    hits: DataFrame, labels: DataFrame, folds: DataFrame, max_hits: int | None = 100, min_weight: float = 0.0
) -> tuple[DataFrame, DataFrame]:
    """(out-of-fold hits, settled, and predictions of the library form)."""
    kept = settled(filter_oof_hits(hits, folds))
    return kept, aggregate_hit_labels(kept, labels, max_hits, min_weight)


def test_transfer(
    hits: DataFrame, labels: DataFrame, exclude_self: bool = True, max_hits: int | None = 100, min_weight: float = 0.0
) -> tuple[DataFrame, DataFrame]:
    """(hits on labelled targets, predictions of the library form).

    The hits are settled, since both results and all that is counted over them rest on the same joins.
    """
    kept = settled(filter_test_hits(hits, labels, exclude_self))
    return kept, aggregate_hit_labels(kept, labels, max_hits, min_weight)


test_transfer.__test__ = False  # not a test, whatever its name


def transfer_top_k(
    weighted: DataFrame,
    labels: DataFrame,
    max_hits: int | None = 100,
    min_weight: float = 0.0,
    max_predictions: int | None = 100,
) -> DataFrame:
    """Noisy-OR transfer cut to the best ``max_predictions`` per entry and branch (the command-line form)."""
    return prune_top_k(aggregate_hit_labels(weighted, labels, max_hits, min_weight), max_predictions)


def transfer_summary(hits: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row of counts: hits, queries, predictions, entries, score range and rows by branch."""
    of_hits = hits.agg(F.count(F.lit(1)).alias("hit_rows"), F.count_distinct("query_id").alias("query_count"))
    of_predictions = predictions.agg(
        F.count(F.lit(1)).alias("prediction_rows"),
        F.count_distinct("entry_id").alias("prediction_entries"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        *(F.count_if(F.col("branch") == b).alias(f"prediction_rows_{b.lower()}") for b in BRANCHES),
    )
    one = of_hits.withColumn("__one", F.lit(1))
    return one.join(of_predictions.withColumn("__one", F.lit(1)), "__one").drop("__one")
