"""FASTA text as a table of sequences. Ids: SRC-01..03."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annofold.sources.fasta_source import BLOCK_BYTES, FastaSource
from annofold.storage import broadcast_if_small, settled

#: Taxon in a header of the form with pipes.
TAXON = r"(?:^|\s)OX=(\d+)(?:\s|$)"
_BLANKS = r"^\s+|\s+$"


def _bare(column: Column) -> Column:
    return F.regexp_replace(column, _BLANKS, "")


def _or_null(column: Column) -> Column:
    return F.when(column != "", column)


def parsed_header(header: Column) -> Column:
    """Struct (entry_id, database, uniprot_name, taxon_id) of a header without its ``>``.

    A header with a pipe is ``database|entry_id|name ... OX=taxon ...``; any other one is
    ``entry_id taxon``, the taxon only if it is all digits. An empty header, and a pipe
    without an entry id, fail the query. A name that is missing is null.
    """
    line = _bare(header)
    piped = F.contains(line, F.lit("|"))
    parts = F.split(line, r"\|", 3)
    entry = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    words = F.split(line, r"\s+")
    second = F.coalesce(F.get(words, F.lit(1)), F.lit(""))
    name = F.coalesce(F.get(F.split(_bare(F.get(parts, F.lit(2))), r"\s+"), F.lit(0)), F.lit(""))
    no_entry = F.raise_error(F.concat(F.lit("header without an entry id: "), line)).cast("string")
    return F.struct(
        F.when(line == "", F.raise_error(F.lit("empty FASTA header")).cast("string"))
        .when(piped, F.when(entry == "", no_entry).otherwise(entry))
        .otherwise(F.get(words, F.lit(0)))
        .alias("entry_id"),
        F.when(piped, _or_null(F.get(parts, F.lit(0)))).alias("database"),
        F.when(piped, _or_null(name)).alias("uniprot_name"),
        F.when(piped, _or_null(F.regexp_extract(line, TAXON, 1)))
        .otherwise(F.when(second.rlike("^[0-9]+$"), second))
        .alias("taxon_id"),
    )


def fasta(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``sequences`` table of a FASTA file, folder or glob, with ``sequence_index`` in file order.

    Files are read in byte ranges (``fasta_source``). A record's number is its place in its range
    plus the records of the ranges before, which a first read counts without building a
    sequence; no text is written or shuffled on the way. Lines are stripped, blank ones
    skipped, and a record's lines joined; a header alone has an empty sequence; text before the
    first header fails the query; an empty file gives no rows.
    """
    spark.dataSource.register(FastaSource)
    read = spark.read.format("fasta").option("blockBytes", block_bytes).option("paths", json.dumps(_expanded(spark, path)))
    counts = settled(read.option("only", "counts").load())
    # One row a range, so a single window over them is small even for many terabytes.
    before = Window.orderBy("c_file", "c_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("file").alias("c_file"), F.col("block").alias("c_block"), "n").filter("n > 0")
    offsets = broadcast_if_small(offsets.select("c_file", "c_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    records = read.option("only", "records").load()
    ranked = records.join(offsets, (F.col("file") == F.col("c_file")) & (F.col("block") == F.col("c_block")))
    told = F.raise_error(F.lit("sequence data before the first FASTA header")).cast("string")
    opened = ranked.select(
        F.when(F.col("opened"), F.col("header")).otherwise(told).alias("header"), "sequence", (F.col("first") + F.col("at")).alias("sequence_index")
    )
    return opened.withColumn("h", parsed_header(F.col("header"))).select(
        F.col("h.entry_id").alias("entry_id"),
        "sequence",
        F.length("sequence").alias("length"),
        "header",
        "sequence_index",
        F.col("h.taxon_id").alias("taxon_id"),
        F.col("h.database").alias("database"),
        F.col("h.uniprot_name").alias("uniprot_name"),
    )


def _expanded(spark: SparkSession, path: str) -> list[str]:
    """Paths that a glob stands for; any other path as it is."""
    if not any(c in path for c in "*?[{"):
        return [path]
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return [f.getPath().toString() for f in found]
