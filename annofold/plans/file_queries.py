"""Queries of the readers and writers of files, with their DuckDB SQL.

Each writes a table in a file format to a fresh folder under the session's shared one, and reads
it back with the library's reader, so that the result stands for the whole way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyarrow import fs as pa_fs
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annofold import sinks, sources
from annofold.operators import embeddings as emb
from annofold.operators import hits as hit_ops
from annofold.operators import predictions as pred
from annofold.operators.ranks import with_row_index
from annofold.operators.tables import label_frequency
from annofold.plans import adapters as ad
from annofold.plans.adapters import with_views
from annofold.storage import scratch_path
from annofold.streaming.embed_stream import start_embedding_stream
from annofold.streaming.manifest_log import commit_manifest, read_manifest

PLACES = 9


def _tsv(df: DataFrame, header: bool) -> str:
    """Path of ``df`` as a folder of tab-separated text."""
    path = f"{scratch_path(df.sparkSession)}.tsv"
    df.write.csv(path, sep="\t", header=header, quote="")
    return path


def _text(lines: DataFrame, ending: str) -> str:
    """Path of a one-column table as a folder of text."""
    path = f"{scratch_path(lines.sparkSession)}{ending}"
    lines.write.text(path)
    return path


def src02_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FASTA in part order: both dialects of headers, sequences of two lines."""
    parts = ad.table(spark, sf_dir, "part")
    letters = F.upper(F.md5(F.col("p_partkey").cast("string")))
    body = F.concat(F.substring(letters, 1, 20), F.lit("\n"), F.substring(letters, 21, 12))
    records = parts.select("p_partkey", F.concat(F.lit(">"), ad.header_of_part(), F.lit("\n"), body).alias("value"))
    path = _text(records.orderBy("p_partkey").select("value"), ".fasta")
    return sources.fasta(spark, path).select("entry_id", "sequence", "length", "sequence_index", "taxon_id", "database", "uniprot_name")


def src04_labels_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with repeated rows, missing terms and padded aspects."""
    done = ad.truth(spark, sf_dir).select(
        F.col("entry_id").alias("EntryID"),
        F.when(F.col("term") == "T00007", F.lit("#N/A N/A")).otherwise(F.col("term")).alias("term"),
        F.when(F.col("branch") == "MF", F.lit(" F ")).when(F.col("branch") == "BP", F.lit("P")).otherwise("C").alias("aspect"),
    )
    return sources.labels_tsv(spark, _tsv(done, True))


def src05_taxonomy_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = ad.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"))
    return sources.taxonomy_tsv(spark, _tsv(customers.union(customers), False))


def src06_taxon_list_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a taxon's rows the first of the file stays."""
    nations = ad.table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("ID"), F.col("n_name").alias("Species"), "n_nationkey")
    return sources.taxon_list_tsv(spark, _tsv(nations.orderBy("n_nationkey").coalesce(1).drop("n_nationkey"), True))


def _obo(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The ontology written as OBO stanzas and read again."""
    kept = ad.raw_edges(spark, sf_dir)
    line = (
        F.when(F.col("relation") == "is_a", F.concat(F.lit("is_a: "), F.col("parent_term"), F.lit(" ! parent")))
        .when(F.col("relation") == "part_of", F.concat(F.lit("relationship: part_of "), F.col("parent_term")))
        .otherwise(F.concat(F.lit("relationship: "), F.col("relation"), F.lit(" "), F.col("parent_term")))
    )
    parents = kept.groupBy(F.col("child_term").alias("child")).agg(F.array_sort(F.collect_list(line)).alias("parents"))
    own = F.array(
        F.lit("[Term]"),
        F.concat(F.lit("id: "), F.col("term")),
        F.concat(F.lit("name: "), F.col("name")),
        F.concat(F.lit("namespace: "), F.col("namespace")),
        F.concat(F.lit("is_obsolete: "), F.col("is_obsolete").cast("string")),
    )
    alt = F.transform("alt_ids", lambda x: F.concat(F.lit("alt_id: "), x))
    none = F.array().cast("array<string>")
    stanzas = ad.stanzas(spark, sf_dir).join(parents, F.col("term") == F.col("child"), "left")
    lines = F.concat(own, alt, F.coalesce("parents", none), F.array(F.lit("")))
    return sources.obo(spark, _text(stanzas.select(F.array_join(lines, "\n").alias("value")), ".obo"))


def src07_obo_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    stanzas, _ = _obo(spark, sf_dir)
    return stanzas.select("term", "name", "namespace", "is_obsolete", F.array_join("alt_ids", ",").alias("alt_ids"))


def src08_obo_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _obo(spark, sf_dir)[1]


def _hits_read(spark: SparkSession, df: DataFrame, header: bool) -> DataFrame:
    hits = hit_ops.normalize_hits(sources.hit_table(spark, _tsv(df, header)))
    for c in ("evalue", "qcov", "tcov"):
        hits = hits.withColumn(c, F.round(c, PLACES))
    return hits


def src09_hits_of_seven_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits_read(spark, ad.hits(spark, sf_dir).select("qseqid", "sseqid", "pident", "evalue", "bits", "qcov", "tcov"), False)


def src09_hits_of_twelve_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    six = [F.lit(k).alias(f"n{k}") for k in range(7)]
    return _hits_read(spark, ad.hits(spark, sf_dir).select("qseqid", "sseqid", "pident", *six, "evalue", "bits"), False)


def src10_hits_with_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits_read(spark, ad.hits(spark, sf_dir), True)


def src13_manifest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest written, read, and moved to another root; two batches have their shards there."""
    config = emb.BatchConfig("train", "/old/artifacts/embeddings/train", 64)
    manifest = emb.create_manifest(emb.normalize_sequences(ad.sequences(spark, sf_dir)), config)
    path = sinks.write_manifest(manifest, f"{scratch_path(spark)}.csv")
    there = spark.createDataFrame([(f"/old/artifacts/embeddings/train/shard_0000{k}.npy",) for k in (0, 2)], "shard_path string")
    return sources.manifest_csv(spark, path, "/new/root", there)


def src15_shard_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors written as shards of a hundred rows and read again, with their places."""
    numbered = ad.table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("batch_"), F.lpad(F.floor(F.col("vec_id") / 100).cast("string"), 5, "0")).alias("batch_id"),
        F.pmod(F.col("vec_id"), F.lit(100)).cast("int").alias("row_index_in_batch"),
        "embedding",
    )
    root = scratch_path(spark).removeprefix("file:")
    sinks.write_shards(numbered, root)
    read = sources.shard_vectors(spark, root)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return read.select(
        F.regexp_extract("shard_path", r"shard_(\d+)\.npy$", 1).alias("shard"),
        "position",
        F.size("embedding").alias("width"),
        F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first"),
        F.round(total, 4).alias("total"),
    )


def snk04_submission_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ordered file of all predictions, read line by line."""
    best = ad.predictions(spark, sf_dir).groupBy("entry_id", "term").agg(F.max("score").alias("score"))
    path = sinks.write_submission_file(best, f"{scratch_path(spark)}.tsv")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    return with_row_index(lines, ["block", "at"], "line_number").select("line_number", F.col("value").alias("line"))


def snk06_batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches as files, read through the paths that the manifest names."""
    root = scratch_path(spark)
    sequences = emb.normalize_sequences(ad.sequences(spark, sf_dir))
    manifest = emb.create_manifest(sequences, emb.BatchConfig("train", root, 64))
    sinks.write_batches(manifest.join(sequences.select("entry_id", "sequence"), "entry_id"), f"{root}/train/batches")
    read = spark.read.parquet(f"{root}/train/batches").withColumn("file", F.regexp_extract(F.input_file_name(), r"[^/]*$", 0))
    return read.select("file", "batch_id", "entry_id", "sequence_length", F.md5("sequence").alias("sequence"), "row_index_in_batch")


def snk07_counted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collapsed predictions with the number of rows that the writer told."""
    path = scratch_path(spark)
    told = sinks.write_parquet_counted(pred.collapse_scores(ad.predictions(spark, sf_dir)), path)
    return spark.read.parquet(path).withColumn("told", F.lit(told).cast("long"))


def snk08_csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label frequencies as a CSV report, read with inferred types."""
    path = sinks.write_csv(label_frequency(ad.truth(spark, sf_dir)), f"{scratch_path(spark)}.csv")
    return sources.typed_table(spark, path).select("branch", "aspect", "term", F.col("n_proteins").cast("long").alias("n_proteins"), F.col("n_annotations").cast("long").alias("n_annotations"))


def src10_typed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text, read with inferred types: numbers are summed as they come."""
    orders = ad.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("cust"), F.round("o_totalprice", 2).alias("price"))
    read = sources.typed_table(spark, _tsv(orders, True))
    kinds = F.lit(",".join(kind for _, kind in read.dtypes))
    grouped = read.groupBy(F.pmod("o_orderkey", F.lit(1000)).cast("long").alias("part"))
    return grouped.agg(F.sum("cust").cast("long").alias("cust"), F.round(F.sum("price"), 2).alias("price")).withColumn("kinds", kinds)


def src11_string_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with leading zeros stay text."""
    customers = ad.table(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("entry_id"), F.col("c_nationkey").alias("cluster_id"))
    return sources.string_table(spark, _tsv(customers, True))


def _counting_encoder(marker: str):
    """Length and number of the letter e of each sequence; the first task that meets a marked row fails, once."""

    def load():
        def encode(some: list[str]) -> list[list[float]]:
            store, inner = sinks.arrow_store(marker)
            if store.get_file_info(inner).type == pa_fs.FileType.NotFound:
                store.create_dir(inner, recursive=True)
                raise RuntimeError("this task was to fail")
            return [[float(len(s)), float(s.count("e"))] for s in some]

        return encode

    return load


def dom19_resumed_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An embedding stream that fails inside a batch and is started again: every shard once, every batch complete."""
    root = scratch_path(spark).removeprefix("file:")
    sequences = emb.normalize_sequences(ad.sequences(spark, sf_dir))
    manifest = emb.create_manifest(sequences, emb.BatchConfig("train", root, 64))
    batches, log = f"{root}/train/batches", f"{root}/manifest"
    sinks.write_batches(manifest.join(sequences.select("entry_id", "sequence"), "entry_id"), batches)
    commit_manifest(manifest, log, 0)
    rounds = max(1, manifest.select("batch_id").distinct().count() // 3)
    for _ in range(2):
        run = start_embedding_stream(
            spark, batches, f"{root}/train", f"{root}/checkpoint", _counting_encoder(f"{root}/failed"), max_length=None,
            manifest_path=log, completed_at="2020-01-01", files_per_round=rounds,
        )
        try:
            run.awaitTermination()
            break
        except StreamingQueryException:
            continue
    shards = sources.shard_vectors(spark, f"{root}/train")
    name = F.regexp_extract("shard_path", r"[^/]*$", 0)
    placed = shards.select(name.alias("shard"), F.col("position").alias("row_index_in_batch"), F.get("embedding", F.lit(0)).alias("letters"), F.get("embedding", F.lit(1)).alias("letters_e"))
    done = read_manifest(spark, log).select("entry_id", "batch_id", "status", "completed_at", name.alias("shard"), "row_index_in_batch")
    return done.join(placed, ["shard", "row_index_in_batch"], "full").select(
        "entry_id", "batch_id", "shard", "row_index_in_batch", "status", "completed_at", F.col("letters").cast("long").alias("letters"), F.col("letters_e").cast("long").alias("letters_e")
    )


FILE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        src02_fasta,
        src04_labels_tsv,
        src05_taxonomy_tsv,
        src06_taxon_list_tsv,
        src07_obo_terms,
        src08_obo_edges,
        src09_hits_of_seven_columns,
        src09_hits_of_twelve_columns,
        src10_hits_with_header,
        src13_manifest_csv,
        src15_shard_vectors,
        snk04_submission_file,
        snk06_batch_files,
        snk07_counted_table,
        snk08_csv_report,
        src10_typed_table,
        src11_string_table,
        dom19_resumed_embedding,
    )
}

_SEVEN = "SELECT DISTINCT query_id, target_id, NULL::DOUBLE AS score, bitscore, round(evalue, 9) AS evalue, pident, "

FILE_SQL: dict[str, str] = {
    "src02_fasta": r"""
WITH h AS (
  SELECT p_partkey, upper(md5(p_partkey::VARCHAR)) AS sequence,
    CASE WHEN p_partkey % 2 = 0 THEN 'sp|P' || p_partkey || '|NAME' || p_size || ' OS=Some name OX=' || p_partkey * 7 || ' GN=x'
      ELSE 'P' || p_partkey || ' ' || CASE WHEN p_size > 10 THEN p_size::VARCHAR ELSE 'n/a' END END AS header,
    row_number() OVER (ORDER BY p_partkey) - 1 AS sequence_index
  FROM part
)
SELECT 'P' || p_partkey AS entry_id, sequence, length(sequence)::INTEGER AS length, sequence_index::BIGINT AS sequence_index,
  CASE WHEN contains(header, '|') THEN regexp_extract(header, 'OX=(\d+)', 1) ELSE nullif(regexp_extract(string_split(header, ' ')[2], '^\d+$'), '') END AS taxon_id,
  CASE WHEN contains(header, '|') THEN 'sp' END AS database,
  CASE WHEN contains(header, '|') THEN string_split(string_split(header, '|')[3], ' ')[1] END AS uniprot_name
FROM h""",
    "src04_labels_tsv": with_views(
        "truth",
        then=""" SELECT DISTINCT entry_id, term, CASE branch WHEN 'MF' THEN 'F' WHEN 'BP' THEN 'P' ELSE 'C' END AS aspect, branch
FROM truth WHERE term <> 'T00007'""",
    ),
    "src05_taxonomy_tsv": "SELECT DISTINCT c_custkey::VARCHAR AS entry_id, c_nationkey::VARCHAR AS taxon_id FROM customer",
    "src06_taxon_list_tsv": "SELECT n_regionkey::VARCHAR AS taxon_id, arg_min(n_name, n_nationkey) AS species FROM nation GROUP BY 1",
    "src07_obo_terms": with_views(
        "all_terms",
        then=""" SELECT term, 'term ' || ltrim(substr(term, 2), '0') || CASE WHEN term = 'T00000' THEN '0' ELSE '' END AS name,
  CASE WHEN branch IS NULL THEN 'elsewhere' WHEN branch = 'MF' THEN 'molecular_function' WHEN branch = 'BP' THEN 'biological_process'
    ELSE 'cellular_component' END AS namespace, is_obsolete, coalesce(alt_id, '') AS alt_ids FROM all_terms""",
    ),
    "src08_obo_edges": with_views(
        "raw_edges",
        "all_terms",
        then=" SELECT child_term, parent_term, relation FROM raw_edges JOIN all_terms ON term = child_term WHERE relation IN ('is_a', 'part_of')",
    ),
    "src09_hits_of_seven_columns": with_views("hits", then=f" {_SEVEN} round(qcov, 9) AS qcov, round(tcov, 9) AS tcov FROM hits"),
    "src09_hits_of_twelve_columns": with_views("hits", then=f" {_SEVEN} NULL::DOUBLE AS qcov, NULL::DOUBLE AS tcov FROM hits"),
    "src10_hits_with_header": with_views("hits", then=f" {_SEVEN} round(qcov, 9) AS qcov, round(tcov, 9) AS tcov FROM hits"),
    "src13_manifest_csv": with_views(
        "sequences",
        then=""", numbered AS (SELECT entry_id, sequence, row_number() OVER (ORDER BY entry_id) - 1 AS i FROM sequences WHERE sequence IS NOT NULL)
SELECT entry_id, 'train' AS split, 'batch_' || lpad((i // 64)::VARCHAR, 5, '0') AS batch_id, i::INTEGER AS row_index, (i % 64)::INTEGER AS row_index_in_batch,
  length(sequence)::INTEGER AS sequence_length, '/new/root/train/batches/batch_' || lpad((i // 64)::VARCHAR, 5, '0') || '.parquet' AS batch_path,
  CASE WHEN i // 64 IN (0, 2) THEN '/old/artifacts/embeddings' ELSE '/new/root' END || '/train/shard_' || lpad((i // 64)::VARCHAR, 5, '0') || '.npy' AS shard_path,
  'esm2_t33_650M_UR50D' AS model_name, 'pending' AS status, '' AS completed_at FROM numbered""",
    ),
    "src15_shard_vectors": """
SELECT lpad((vec_id // 100)::VARCHAR, 5, '0') AS shard, (row_number() OVER (PARTITION BY vec_id // 100 ORDER BY vec_id) - 1)::INTEGER AS position,
  len(embedding)::INTEGER AS width, round(embedding[1]::DOUBLE, 6) AS first, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) AS total
FROM embeddings""",
    "snk04_submission_file": with_views(
        "predictions",
        then=""", best AS (SELECT entry_id, term, max(score) AS score FROM predictions GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY entry_id, score DESC, term) - 1 AS line_number, entry_id || chr(9) || term || chr(9) || score::VARCHAR AS line FROM best""",
    ),
    "snk06_batch_files": with_views(
        "sequences",
        then=""", numbered AS (SELECT entry_id, sequence, row_number() OVER (ORDER BY entry_id) - 1 AS i FROM sequences WHERE sequence IS NOT NULL)
SELECT 'batch_' || lpad((i // 64)::VARCHAR, 5, '0') || '.parquet' AS file, 'batch_' || lpad((i // 64)::VARCHAR, 5, '0') AS batch_id, entry_id,
  length(sequence)::INTEGER AS sequence_length, md5(sequence) AS sequence, (i % 64)::INTEGER AS row_index_in_batch FROM numbered""",
    ),
    "snk07_counted_table": with_views(
        "predictions",
        then=""" SELECT entry_id, term, branch, max(score) AS score, count(*) OVER () AS told FROM predictions GROUP BY ALL""",
    ),
    "snk08_csv_report": with_views(
        "truth",
        then=""" SELECT branch, CASE branch WHEN 'MF' THEN 'F' WHEN 'BP' THEN 'P' ELSE 'C' END AS aspect, term, count(DISTINCT entry_id) AS n_proteins,
  (SELECT count(*) FROM lineitem WHERE l_linestatus = 'F' AND 'T' || lpad((l_partkey % 120)::VARCHAR, 5, '0') = term) AS n_annotations FROM truth GROUP BY ALL""",
    ),
    "src10_typed_table": """SELECT o_orderkey % 1000 AS part, sum(o_custkey)::BIGINT AS cust, round(sum(round(o_totalprice, 2)), 2) AS price, 'int,int,double' AS kinds
FROM orders GROUP BY 1""",
    "src11_string_table": "SELECT lpad(c_custkey::VARCHAR, 9, '0') AS entry_id, c_nationkey::VARCHAR AS cluster_id FROM customer",
    "dom19_resumed_embedding": with_views(
        "sequences",
        then=""", numbered AS (SELECT entry_id, sequence, row_number() OVER (ORDER BY entry_id) - 1 AS i FROM sequences WHERE sequence IS NOT NULL)
SELECT entry_id, 'batch_' || lpad((i // 64)::VARCHAR, 5, '0') AS batch_id, 'shard_' || lpad((i // 64)::VARCHAR, 5, '0') || '.npy' AS shard,
  (i % 64)::INTEGER AS row_index_in_batch, 'complete' AS status, '2020-01-01' AS completed_at,
  length(sequence)::BIGINT AS letters, (length(sequence) - length(replace(sequence, 'e', '')))::BIGINT AS letters_e FROM numbered""",
    ),
}
