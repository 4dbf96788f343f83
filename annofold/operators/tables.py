"""Ingestion summaries. Ids: AGG-01, AGG-02, AGG-21, JOI-16, build composites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annofold.schemas import BRANCH_TO_ASPECT, fail_if_any, mapped, require_columns


def label_frequency(labels: DataFrame) -> DataFrame:
    """(branch, aspect, term, n_proteins, n_annotations)."""
    require_columns(labels, ("entry_id", "term", "branch"), "labels")
    aspect = F.col("aspect") if "aspect" in labels.columns else mapped(F.col("branch"), BRANCH_TO_ASPECT)
    return labels.select("branch", aspect.alias("aspect"), "term", "entry_id").groupBy("branch", "aspect", "term").agg(
        F.count_distinct("entry_id").alias("n_proteins"), F.count(F.lit(1)).alias("n_annotations")
    )


def sequence_summary(sequences: DataFrame) -> DataFrame:
    """One row: n_sequences, n_unique_entry_ids, min, mean, median and max length; zeros for an empty table.

    The median is exact; lengths are combined to counts before they meet.
    """
    per = sequences.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    lengths = per.agg(
        F.sum("n").alias("n_sequences"),
        F.min("length").alias("min_length"),
        (F.sum(F.col("length") * F.col("n")) / F.sum(F.when(F.col("length").isNotNull(), F.col("n")))).alias("mean_length"),
        F.percentile("length", 0.5, F.col("n")).alias("median_length"),
        F.max("length").alias("max_length"),
    )
    ids = sequences.agg(F.count_distinct("entry_id").alias("n_unique_entry_ids"))
    both = lengths.withColumn("__one", F.lit(1)).join(ids.withColumn("__one", F.lit(1)), "__one").drop("__one")
    kinds = {"mean_length": "double", "median_length": "double", "min_length": "long", "max_length": "long"}
    names = ("n_sequences", "n_unique_entry_ids", "min_length", "mean_length", "median_length", "max_length")
    return both.select(*(F.coalesce(F.col(c), F.lit(0)).cast(kinds.get(c, "long")).alias(c) for c in names))


def require_unique_ids(sequences: DataFrame, name: str) -> None:
    """Fail on a repeated entry_id."""
    fail_if_any(sequences.groupBy("entry_id").count().filter("count > 1"), f"{name} repeats entries", "entry_id")


def require_labelled_known(labels: DataFrame, sequences: DataFrame) -> None:
    """Fail on a labelled entry without a sequence."""
    absent = labels.select("entry_id").distinct().join(sequences, "entry_id", "left_anti")
    fail_if_any(absent, "labelled entries without a sequence", "entry_id")


def test_taxonomy(sequences: DataFrame, taxa: DataFrame) -> DataFrame:
    """(entry_id, taxon_id, species): species are null where the taxon is absent or unknown."""
    return sequences.select("entry_id", "taxon_id").join(taxa.select("taxon_id", "species"), "taxon_id", "left").select(
        "entry_id", "taxon_id", "species"
    )


test_taxonomy.__test__ = False  # not a test, whatever its name


def ingestion_issues(sequences: DataFrame, taxonomy: DataFrame, test_taxa: DataFrame) -> DataFrame:
    """(issue, id) of entries and taxa that do not match between the input tables."""
    ids = sequences.select("entry_id").distinct()
    known = taxonomy.select("entry_id").distinct()

    def named(df: DataFrame, issue: str, column: str) -> DataFrame:
        return df.select(F.lit(issue).alias("issue"), F.col(column).alias("id")).distinct()

    return (
        named(ids.join(known, "entry_id", "left_anti"), "sequence_without_taxonomy", "entry_id")
        .union(named(known.join(ids, "entry_id", "left_anti"), "taxonomy_without_sequence", "entry_id"))
        .union(named(test_taxa.filter("taxon_id IS NULL"), "test_entry_without_taxon", "entry_id"))
        .union(named(test_taxa.filter("taxon_id IS NOT NULL AND species IS NULL"), "test_taxon_without_species", "taxon_id"))
    )
