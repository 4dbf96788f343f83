"""The driver's tables seen as tables of this domain, and the same views as SQL.

Every adapter is a narrow projection of one table, so filters and columns still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Distinct terms that parts are mapped to.
N_TERMS = 120
_BRANCHES = ("MF", "BP", "CC")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("long").cast("string")


def _term_name(k: Column) -> Column:
    return F.concat(F.lit("T"), F.lpad(k.cast("string"), 5, "0"))


def _branch_of(k: Column) -> Column:
    return F.get(F.array(*(F.lit(b) for b in _BRANCHES)), F.pmod(k, F.lit(3)).cast("int"))


def _k() -> Column:
    return F.pmod(F.col("l_partkey"), F.lit(N_TERMS))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entry_id, term, branch, score) with repeated keys."""
    return table(spark, sf_dir, "lineitem").select(
        _text(F.col("l_orderkey")).alias("entry_id"),
        _term_name(_k()).alias("term"),
        _branch_of(_k()).alias("branch"),
        (F.col("l_quantity") / 50).alias("score"),
    )


def supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second prediction table over the same keys."""
    return table(spark, sf_dir, "lineitem").select(
        _text(F.col("l_orderkey")).alias("entry_id"),
        _term_name(_k()).alias("term"),
        _branch_of(_k()).alias("branch"),
        (F.col("l_discount") * 8).alias("score"),
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entry_id, term, branch), with repeated rows."""
    done = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'")
    return done.select(_text(F.col("l_orderkey")).alias("entry_id"), _term_name(_k()).alias("term"), _branch_of(_k()).alias("branch"))


def raw_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entry_id, term, branch) with alternative, obsolete and unknown terms among them."""
    k = F.pmod(F.col("l_partkey"), F.lit(N_TERMS + 12))
    name = F.when(k < N_TERMS, _term_name(k)).when(k < N_TERMS + 6, F.concat(F.lit("ALT"), _text(k - N_TERMS))).otherwise(_term_name(k))
    done = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'")
    return done.select(_text(F.col("l_orderkey")).alias("entry_id"), name.alias("term"), _branch_of(k).alias("branch"))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qseqid, sseqid, bits, evalue, pident, qcov, tcov): orders as queries and targets, with hits on themselves."""
    n = table(spark, sf_dir, "orders").count()  # from the footers
    target = F.pmod(F.col("l_orderkey") + F.col("l_linenumber") - 1, F.lit(n))
    return table(spark, sf_dir, "lineitem").select(
        _text(F.col("l_orderkey")).alias("qseqid"),
        _text(target).alias("sseqid"),
        F.col("l_extendedprice").alias("bits"),
        F.pow(F.lit(10.0), -(F.col("l_discount") * 1000 + 1)).alias("evalue"),
        (F.col("l_quantity") * 2).alias("pident"),
        (1 - F.col("l_discount")).alias("qcov"),
        (1 - F.col("l_tax")).alias("tcov"),
    )


def folds_of_orders(spark: SparkSession, sf_dir: str, n_folds: int = 5) -> DataFrame:
    """(entry_id, fold)."""
    return table(spark, sf_dir, "orders").select(
        _text(F.col("o_orderkey")).alias("entry_id"), F.pmod(F.col("o_custkey"), F.lit(n_folds)).cast("int").alias("fold")
    )


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.pmod(F.col("p_partkey"), F.lit(N_TERMS + 12)).alias("k")).distinct()


def stanzas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ontology terms: 120 active ones, some with an alternative id, 6 obsolete, and 6 of an unknown namespace."""
    k = F.col("k")
    spaces = F.array(F.lit("molecular_function"), F.lit("biological_process"), F.lit("cellular_component"))
    alt = F.when(k < 6, F.array(F.concat(F.lit("ALT"), _text(k)))).otherwise(F.array().cast("array<string>"))
    return _parts(spark, sf_dir).select(
        _term_name(k).alias("term"),
        F.concat(F.lit("term "), _text(k)).alias("name"),
        F.when(k >= N_TERMS + 9, F.lit("elsewhere")).otherwise(F.get(spaces, F.pmod(k, F.lit(3)).cast("int"))).alias("namespace"),
        ((k >= N_TERMS + 6) & (k < N_TERMS + 9)).alias("is_obsolete"),
        alt.alias("alt_ids"),
    ).filter(k_not_alt())


def k_not_alt() -> Column:
    """Numbers that stand for a term of their own, not for an alternative id."""
    return ~F.col("term").isin(*(f"T{k:05d}" for k in range(N_TERMS, N_TERMS + 6)))


def raw_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ontology edges: two parents per term within its branch, and some that must be dropped."""
    k = F.col("k")
    q = F.floor(k / 3)
    b = F.pmod(k, F.lit(3))
    kinds = F.array(
        F.struct((3 * F.floor(q / 2) + b).cast("long").alias("p"), F.lit("is_a").alias("relation")),
        F.struct((3 * F.floor(q / 3) + b).cast("long").alias("p"), F.lit("part_of").alias("relation")),
        F.struct((3 * F.floor(q / 2) + F.pmod(b + 1, F.lit(3))).cast("long").alias("p"), F.lit("part_of").alias("relation")),
        F.struct((k + 1000).cast("long").alias("p"), F.lit("is_a").alias("relation")),
        F.struct(F.lit(0).cast("long").alias("p"), F.lit("regulates").alias("relation")),
    )
    return _parts(spark, sf_dir).filter("k >= 3").select("k", F.explode(kinds).alias("e")).select(
        _term_name(k).alias("child_term"), _term_name(F.col("e.p")).alias("parent_term"), F.col("e.relation").alias("relation")
    )


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entry_id, sequence, length, taxon_id)."""
    return table(spark, sf_dir, "documents").select(
        _text(F.col("doc_id")).alias("entry_id"),
        F.col("text").alias("sequence"),
        F.col("n_chars").cast("int").alias("length"),
        F.col("lang").alias("taxon_id"),
    )


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entry_id, cluster_id): clusters of growing sizes; entries without a label have none."""
    return table(spark, sf_dir, "labels").select(
        _text(F.col("doc_id")).alias("entry_id"),
        F.concat(F.lit("c"), _text(F.floor(F.sqrt(F.col("doc_id").cast("double"))))).alias("cluster_id"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entry_id, embedding, label)."""
    return table(spark, sf_dir, "embeddings").select(
        _text(F.col("vec_id")).alias("entry_id"), "embedding", _text(F.col("label")).alias("label")
    )


def header_of_part() -> Column:
    """A header of one of the two dialects, from the columns of parts."""
    piped = F.concat_ws(
        "|", F.lit("sp"), F.concat(F.lit("P"), _text(F.col("p_partkey"))),
        F.concat(F.lit("NAME"), _text(F.col("p_size")), F.lit(" OS=Some name OX="), _text(F.col("p_partkey") * 7), F.lit(" GN=x")),
    )
    plain = F.concat(F.lit("P"), _text(F.col("p_partkey")), F.lit(" "), F.when(F.col("p_size") > 10, _text(F.col("p_size"))).otherwise("n/a"))
    return F.when(F.col("p_partkey") % 2 == 0, piped).otherwise(plain)


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(header) of both dialects, from parts."""
    return table(spark, sf_dir, "part").select(header_of_part().alias("header"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entry_id): keys of which some are orders' and some are not."""
    return table(spark, sf_dir, "customer").select(_text(F.col("c_custkey")).alias("entry_id"))


_TERM_SQL = f"""'T' || lpad((l_partkey % {N_TERMS})::VARCHAR, 5, '0') AS term,
    CASE l_partkey % {N_TERMS} % 3 WHEN 0 THEN 'MF' WHEN 1 THEN 'BP' ELSE 'CC' END AS branch"""

#: The same views as common table expressions.
SQL_VIEWS = {
    "predictions": f"predictions AS (SELECT l_orderkey::VARCHAR AS entry_id, {_TERM_SQL}, l_quantity / 50 AS score FROM lineitem)",
    "supervised": f"supervised AS (SELECT l_orderkey::VARCHAR AS entry_id, {_TERM_SQL}, l_discount * 8 AS score FROM lineitem)",
    "truth": f"truth AS (SELECT DISTINCT l_orderkey::VARCHAR AS entry_id, {_TERM_SQL} FROM lineitem WHERE l_linestatus = 'F')",
    "raw_labels": f"""raw_labels AS (
  SELECT entry_id, CASE WHEN k BETWEEN {N_TERMS} AND {N_TERMS + 5} THEN 'ALT' || (k - {N_TERMS})::VARCHAR ELSE 'T' || lpad(k::VARCHAR, 5, '0') END AS term,
    CASE k % 3 WHEN 0 THEN 'MF' WHEN 1 THEN 'BP' ELSE 'CC' END AS branch
  FROM (SELECT l_orderkey::VARCHAR AS entry_id, l_partkey % {N_TERMS + 12} AS k FROM lineitem WHERE l_linestatus = 'F'))""",
    "hits": """hits AS (
  SELECT DISTINCT l_orderkey::VARCHAR AS query_id, ((l_orderkey + l_linenumber - 1) % (SELECT count(*) FROM orders))::VARCHAR AS target_id,
    l_extendedprice AS bitscore, power(10.0, -(l_discount * 1000 + 1)) AS evalue, l_quantity * 2 AS pident, 1 - l_discount AS qcov, 1 - l_tax AS tcov
  FROM lineitem)""",
    "folds": "folds AS (SELECT o_orderkey::VARCHAR AS entry_id, (o_custkey % 5)::INTEGER AS fold FROM orders)",
    "parts": f"parts AS (SELECT DISTINCT p_partkey % {N_TERMS + 12} AS k FROM part)",
    "all_terms": f"""all_terms AS (
  SELECT 'T' || lpad(k::VARCHAR, 5, '0') AS term,
    CASE WHEN k >= {N_TERMS + 9} THEN NULL WHEN k % 3 = 0 THEN 'MF' WHEN k % 3 = 1 THEN 'BP' ELSE 'CC' END AS branch,
    k BETWEEN {N_TERMS + 6} AND {N_TERMS + 8} AS is_obsolete, CASE WHEN k < 6 THEN 'ALT' || k::VARCHAR END AS alt_id
  FROM parts WHERE k NOT BETWEEN {N_TERMS} AND {N_TERMS + 5})""",
    "terms": "terms AS (SELECT * FROM all_terms WHERE NOT is_obsolete AND branch IS NOT NULL)",
    "raw_edges": """raw_edges AS (
  SELECT 'T' || lpad(k::VARCHAR, 5, '0') AS child_term, 'T' || lpad(e.p::VARCHAR, 5, '0') AS parent_term, e.relation AS relation
  FROM (SELECT k, unnest([
      struct_pack(p := 3 * (k // 3 // 2) + k % 3, relation := 'is_a'), struct_pack(p := 3 * (k // 3 // 3) + k % 3, relation := 'part_of'),
      struct_pack(p := 3 * (k // 3 // 2) + (k % 3 + 1) % 3, relation := 'part_of'), struct_pack(p := k + 1000, relation := 'is_a'),
      struct_pack(p := 0, relation := 'regulates')]) AS e FROM parts WHERE k >= 3))""",
    "edges": """edges AS (
  SELECT DISTINCT child_term, parent_term FROM raw_edges JOIN terms c ON c.term = child_term JOIN terms p ON p.term = parent_term
  WHERE relation IN ('is_a', 'part_of') AND c.branch = p.branch)""",
    "paths": """paths AS (
  SELECT child_term AS term, parent_term AS ancestor, 1 AS distance FROM edges
  UNION
  SELECT paths.term, edges.parent_term, paths.distance + 1 FROM paths JOIN edges ON paths.ancestor = edges.child_term)""",
    "ancestors": """ancestors AS (
  SELECT paths.term, ancestor, min(distance) AS distance, any_value(t.branch) AS term_branch, any_value(a.branch) AS ancestor_branch
  FROM paths JOIN terms t ON t.term = paths.term JOIN terms a ON a.term = paths.ancestor WHERE paths.term <> ancestor GROUP BY paths.term, ancestor)""",
    "sequences": "sequences AS (SELECT doc_id::VARCHAR AS entry_id, text AS sequence, n_chars::INTEGER AS length, lang AS taxon_id FROM documents)",
    "clusters": "clusters AS (SELECT doc_id::VARCHAR AS entry_id, 'c' || floor(sqrt(doc_id::DOUBLE))::BIGINT::VARCHAR AS cluster_id FROM labels)",
    "vectors": "vectors AS (SELECT vec_id::VARCHAR AS entry_id, embedding, label::VARCHAR AS label FROM embeddings)",
}

_NEEDS = {
    "all_terms": ("parts",),
    "terms": ("all_terms",),
    "raw_edges": ("parts",),
    "edges": ("raw_edges", "terms"),
    "paths": ("edges",),
    "ancestors": ("paths", "terms"),
}


def with_views(*names: str, then: str) -> str:
    """A WITH clause of the named views and what they need, followed by ``then`` (more views, or a SELECT)."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    start = "WITH RECURSIVE " if "paths" in order else "WITH "
    return start + ",\n".join(SQL_VIEWS[n] for n in order) + then
