"""Tab- and comma-separated annotation tables. Ids: SRC-04..06, SRC-09..12."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annofold.operators.hits import HIT_ALIASES, first_present
from annofold.schemas import ASPECT_TO_BRANCH, NULL_TOKENS, fail_if_any, mapped, require_columns

# Columns of hit files without a header.
SEVEN_COLUMNS = ("query_id", "target_id", "pident", "evalue", "bitscore", "qcov", "tcov")
TWELVE_COLUMNS = (
    "query_id",
    "target_id",
    "pident",
    "alnlen",
    "mismatch",
    "gapopen",
    "qstart",
    "qend",
    "tstart",
    "tend",
    "evalue",
    "bitscore",
)
THREE_COLUMNS = ("query_id", "target_id", "score")


def _present(column: str) -> Column:
    """The value, or null where the text stands for a missing one."""
    return F.when(~F.col(column).isin(*NULL_TOKENS), F.col(column))


def _strings(spark: SparkSession, path: str, sep: str, header: bool) -> DataFrame:
    """All columns as text, missing values as null."""
    read = spark.read.csv(path, sep=sep, header=header, inferSchema=False, quote="" if sep == "\t" else '"')
    return read.select(*(_present(f"`{c}`").alias(c) for c in read.columns))


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return "." + name.rsplit(".", 1)[-1].lower() if "." in name else ""


def labels_tsv(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    """Distinct (entry_id, term, aspect, branch) of a file with the columns EntryID, term, aspect.

    Rows with a missing value go; ``validate`` fails at once on an aspect outside F, P and C.
    """
    raw = _strings(spark, path, "\t", True)
    require_columns(raw, ("EntryID", "term", "aspect"), "labels")
    rows = raw.select(F.col("EntryID").alias("entry_id"), "term", F.trim("aspect").alias("aspect")).na.drop()
    out = rows.withColumn("branch", mapped(F.col("aspect"), ASPECT_TO_BRANCH)).dropDuplicates()
    if validate:
        fail_if_any(out.filter("branch IS NULL").select("aspect").distinct(), "unknown aspects", "aspect")
    return out


def taxonomy_tsv(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    """Distinct (entry_id, taxon_id) of a file without a header; ``validate`` fails on an entry of several taxa."""
    raw = _strings(spark, path, "\t", False)
    a, b = raw.columns[:2]
    out = raw.select(F.col(a).alias("entry_id"), F.col(b).alias("taxon_id")).na.drop().dropDuplicates()
    if validate:
        fail_if_any(out.groupBy("entry_id").count().filter("count > 1"), "entries of several taxa", "entry_id")
    return out


def taxon_list_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(taxon_id, species), one row per taxon, of a file with the columns ID and Species.

    Of a taxon's rows the first of the file stays: taxon lists are one small file, read in
    order of its blocks.
    """
    raw = spark.read.csv(path, sep="\t", header=True, inferSchema=False, quote="")
    require_columns(raw, ("ID", "Species"), "taxon list")
    placed = raw.select(
        F.when(~F.col("ID").isin(*NULL_TOKENS), F.col("ID")).alias("taxon_id"),
        F.when(~F.col("Species").isin(*NULL_TOKENS), F.col("Species")).alias("species"),
        F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
    )
    first = F.min_by(F.struct("species"), F.col("at")).alias("first")
    return placed.filter("taxon_id IS NOT NULL").groupBy("taxon_id").agg(first).select("taxon_id", "first.species")


def hit_table(spark: SparkSession, path: str) -> DataFrame:
    """A hit file: Parquet, CSV, or tab-separated (.tsv, .txt, .m8) with or without a header.

    The first line of a tab-separated file is a header when it names both a query and a
    target. Without one, 7 columns, 12 or more, and 3 or more have fixed meanings.
    """
    suffix = _suffix(path)
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix == ".csv":
        return _strings(spark, path, ",", True)
    if suffix not in (".tsv", ".txt", ".m8"):
        raise ValueError(f"unsupported hit table: {path}")
    head = spark.read.text(path).limit(1).collect()
    names = head[0][0].split("\t") if head else []
    if all(first_present(names, HIT_ALIASES[k]) for k in ("query_id", "target_id")):
        return _strings(spark, path, "\t", True)
    wanted = SEVEN_COLUMNS if len(names) == 7 else TWELVE_COLUMNS if len(names) >= 12 else THREE_COLUMNS
    if len(names) < 3:
        raise ValueError(f"a hit table without a header needs 3 columns: {path}")
    raw = _strings(spark, path, "\t", False)
    return raw.select(*(F.col(f"`{old}`").alias(new) for old, new in zip(raw.columns, wanted, strict=False)))


def typed_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet, CSV or tab-separated table with inferred types."""
    return _table(spark, path, infer=True)


def string_table(spark: SparkSession, path: str) -> DataFrame:
    """The same with all columns as text."""
    return _table(spark, path, infer=False)


def _table(spark: SparkSession, path: str, infer: bool) -> DataFrame:
    suffix = _suffix(path)
    if suffix == ".parquet":
        read = spark.read.parquet(path)
        return read if infer else read.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in read.columns))
    if suffix not in (".csv", ".tsv", ".txt"):
        raise ValueError(f"unsupported table: {path}")
    sep = "," if suffix == ".csv" else "\t"
    return spark.read.csv(path, sep=sep, header=True, inferSchema=True) if infer else _strings(spark, path, sep, True)
