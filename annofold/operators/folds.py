"""Cross-validation folds that keep clusters whole.

Ids: PRJ-09..11, SEQ-01..03, AGG-09, AGG-14, AGG-15, JOI-11..13.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annofold.functions import length_bin, stable_hash
from annofold.schemas import fail_if_any, not_missing, require_columns
from annofold.storage import settled

FOLD_COLUMNS = ("entry_id", "fold", "cluster_id", "cluster_source", "taxon_id", "length", "length_bin", "stratification_key")
#: Hex digits of the hash that cut clusters of one size into parts: 4,096 even ones.
PART_DIGITS = 3


@dataclass(frozen=True)
class FoldConfig:
    """Number of folds and seed of the order among clusters of one size."""

    n_folds: int = 5
    seed: int = 42


def cluster_assignments(sequences: DataFrame, clusters: DataFrame | None = None, validate: bool = True) -> DataFrame:
    """One row per entry with its cluster, length bin and stratification key.

    An entry without a cluster is one of its own. ``validate`` fails at once on an entry of
    several clusters. Of repeated entries one row stays: the smallest by all columns.
    """
    require_columns(sequences, ("entry_id",), "sequences")
    length = F.col("length").cast("int") if "length" in sequences.columns else F.lit(None).cast("int")
    taxon = F.col("taxon_id").cast("string") if "taxon_id" in sequences.columns else F.lit("unknown")
    bins = length_bin(F.col("length")) if "length" in sequences.columns else F.lit("unknown")
    entries = (
        sequences.select(F.col("entry_id").cast("string").alias("entry_id"), taxon.alias("taxon_id"), length.alias("length"))
        .filter("entry_id IS NOT NULL")
        .groupBy("entry_id")
        .agg(F.min(F.struct("taxon_id", "length")).alias("row"))
        .select("entry_id", "row.taxon_id", "row.length")
    )
    if clusters is None:
        placed = entries.withColumn("given", F.lit(None).cast("string"))
    else:
        require_columns(clusters, ("entry_id", "cluster_id"), "clusters")
        given = clusters.select(
            F.col("entry_id").cast("string").alias("c_entry"), F.col("cluster_id").cast("string").alias("given")
        )
        given = given.filter(not_missing("c_entry", "given")).groupBy("c_entry").agg(
            F.min("given").alias("given"), F.max("given").alias("other")
        )
        if validate:
            fail_if_any(given.filter("given != other"), "entries of several clusters", "c_entry")
        placed = entries.join(given.drop("other"), F.col("entry_id") == F.col("c_entry"), "left").drop("c_entry")
    return placed.select(
        "entry_id",
        "taxon_id",
        "length",
        F.coalesce("given", F.concat(F.lit("singleton:"), F.col("entry_id"))).alias("cluster_id"),
        F.when(F.col("given").isNull(), F.lit("entry_id_singleton")).otherwise("provided_cluster").alias("cluster_source"),
        bins.alias("length_bin"),
        F.concat_ws("|", F.coalesce("taxon_id", F.lit("unknown")), bins).alias("stratification_key"),
    )


def balance_runs(histogram: list[tuple[int, int]], n_folds: int) -> list[tuple[int, int, int, list[int]]]:
    """Greedy balancing over (cluster size, number of clusters), largest first.

    Each cluster goes to the fold with the fewest entries, then the fewest clusters, then the
    lowest number. Clusters of one size come in runs (size, first rank, count, folds): rank r
    of a run goes to folds[(r - first) % len(folds)]. While the lowest folds lie within one
    size of each other they take turns, so a run covers any number of clusters at once and
    the work depends on distinct sizes and folds only.
    """
    entries, groups = [0] * n_folds, [0] * n_folds
    runs: list[tuple[int, int, int, list[int]]] = []
    for size, count in sorted(histogram, reverse=True):
        at = 0
        while at < count:
            order = sorted(range(n_folds), key=lambda f: (entries[f], groups[f], f))
            turn = [f for f in order if entries[f] < entries[order[0]] + size]
            rounds = (count - at) // len(turn)
            if len(turn) < n_folds:
                bound, top = entries[order[len(turn)]], entries[turn[-1]]
                rounds = min(rounds, (bound - top - 1) // size + 1)
            if rounds == 0:
                turn, rounds = turn[: min(len(turn), count - at)], 1
            runs.append((size, at, rounds * len(turn), turn))
            for f in turn:
                entries[f] += rounds * size
                groups[f] += rounds
            at += rounds * len(turn)
    return runs


def assign_folds(assigned: DataFrame, config: FoldConfig = FoldConfig()) -> DataFrame:
    """``assigned`` with a ``fold``: whole clusters, balanced by entries, the same on every run.

    Only the histogram of cluster sizes (at most sqrt(2 x entries) rows) reaches the driver.
    A cluster's rank within its size is its rank within a part of the hash range plus the
    parts before, so millions of singletons are ranked by many tasks. Entries with equal
    clusters are joined to them, and a very large cluster is split by AQE.
    """
    if config.n_folds < 2:
        raise ValueError("there must be at least 2 folds")
    spark = assigned.sparkSession
    sizes = settled(
        assigned.groupBy("cluster_id")
        .agg(F.count_distinct("entry_id").alias("size"))
        .withColumn("hash", stable_hash(F.col("cluster_id"), config.seed))
        .withColumn("part", F.substring("hash", 1, PART_DIGITS))
    )
    histogram = [(r["size"], r["n"]) for r in sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()]
    runs = _runs_frame(spark, balance_runs(histogram, config.n_folds))
    earlier = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sizes.groupBy("size", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("size", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("size", "part").orderBy("hash", "cluster_id")
    ranked = (
        sizes.withColumn("at", F.row_number().over(inside) - 1)
        .join(offsets, ["size", "part"])
        .select("cluster_id", "size", (F.col("at") + F.col("offset")).alias("rank"))
    )
    chosen = ranked.join(runs, "size").filter("rank >= first AND rank < first + count").select(
        F.col("cluster_id").alias("of_cluster"),
        F.get("folds", ((F.col("rank") - F.col("first")) % F.size("folds")).cast("int")).alias("fold"),
    )
    return assigned.join(chosen, F.col("cluster_id") == F.col("of_cluster")).drop("of_cluster")


def _runs_frame(spark: SparkSession, runs: list[tuple[int, int, int, list[int]]]) -> DataFrame:
    return spark.createDataFrame(runs, "size long, first long, count long, folds array<int>")


def make_folds(sequences: DataFrame, clusters: DataFrame | None = None, config: FoldConfig = FoldConfig()) -> DataFrame:
    """The fold table of ``sequences`` (entry_id, optionally length and taxon_id)."""
    return assign_folds(cluster_assignments(sequences, clusters), config).select(*FOLD_COLUMNS)


def validate_folds(folds: DataFrame) -> DataFrame:
    """One row: n_entries, n_rows, n_clusters, n_folds, duplicate_entry_count, cluster_leak_count, max and min fold size."""
    require_columns(folds, ("entry_id", "fold", "cluster_id"), "folds")
    whole = folds.agg(
        F.count_distinct("entry_id").alias("n_entries"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("cluster_id").alias("n_clusters"),
        F.count_distinct("fold").alias("n_folds"),
    )
    leaks = leaking_clusters(folds).agg(F.count(F.lit(1)).alias("cluster_leak_count"))
    sizes = fold_sizes(folds).agg(F.max("n_entries").alias("largest_fold"), F.min("n_entries").alias("smallest_fold"))
    one = [df.withColumn("__one", F.lit(1)) for df in (whole, leaks, sizes)]
    return one[0].join(one[1], "__one").join(one[2], "__one").select(
        "n_entries",
        "n_rows",
        "n_clusters",
        "n_folds",
        (F.col("n_rows") - F.col("n_entries")).alias("duplicate_entry_count"),
        "cluster_leak_count",
        "largest_fold",
        "smallest_fold",
    )


def leaking_clusters(folds: DataFrame) -> DataFrame:
    """(cluster_id, n_folds) of clusters that lie in several folds."""
    per = folds.groupBy("cluster_id").agg(F.count_distinct("fold").alias("n_folds"))
    return per.filter("n_folds > 1 AND cluster_id IS NOT NULL")


def fold_sizes(folds: DataFrame) -> DataFrame:
    """(fold, n_entries, n_clusters)."""
    return folds.groupBy("fold").agg(
        F.count_distinct("entry_id").alias("n_entries"), F.count_distinct("cluster_id").alias("n_clusters")
    )


def fold_label_report(folds: DataFrame, labels: DataFrame) -> DataFrame:
    """(fold, branch, n_terms, n_rows) of labels by fold."""
    fold_of = folds.select(F.col("entry_id").cast("string").alias("f_entry"), "fold")
    joined = labels.filter("branch IS NOT NULL").join(fold_of, F.col("entry_id").cast("string") == F.col("f_entry"))
    return joined.groupBy("fold", "branch").agg(F.count_distinct("term").alias("n_terms"), F.count(F.lit(1)).alias("n_rows"))
