"""DuckDB SQL for the registered queries of the library's own operators."""

from __future__ import annotations

from annofold.functions import thresholds
from annofold.functions.scalars import LENGTH_BINS, LONGEST_BIN
from annofold.plans.adapters import with_views
from annofold.plans.file_queries import FILE_SQL

_COLLAPSED = "(SELECT entry_id, term, branch, max(least(1.0, greatest(0.0, score))) AS score FROM {} GROUP BY ALL)"


def _bins(column: str) -> str:
    cases = " ".join(f"WHEN coalesce({column}, 0) <= {end} THEN '{name}'" for end, name in LENGTH_BINS)
    return f"CASE {cases} ELSE '{LONGEST_BIN}' END"


_HASH = "substr(sha1('42:' || {}), 1, 16)"

# Weighted hits by each base.
_WEIGHTED = """, weighted AS (
  SELECT * FROM (SELECT *, least(1.0, greatest(0.0, {base} * sqrt(qcov * tcov))) AS hit_weight FROM hits) WHERE hit_weight > 0
)"""
_BY_BITS = _WEIGHTED.format(base="(bitscore / max(bitscore) OVER (PARTITION BY query_id))")
_PIDENT = "(CASE WHEN pident > 1 THEN pident / 100 ELSE pident END)"


def _weights(base: str) -> str:
    return with_views("hits", then=_WEIGHTED.format(base=base) + "SELECT query_id, target_id, round(hit_weight, 9) AS hit_weight FROM weighted")


def _without(columns: str) -> str:
    """Weights of hits from which ``columns`` were left out before duplicates went."""
    return f", hits2 AS (SELECT DISTINCT {columns} FROM hits)"


_OOF = """, oof AS (
  SELECT w.*, q.fold AS query_fold, t.fold AS target_fold FROM weighted w JOIN folds q ON q.entry_id = query_id JOIN folds t ON t.entry_id = target_id
  WHERE query_id <> target_id AND q.fold <> t.fold
)"""
_TEST = """, kept AS (
  SELECT * FROM weighted WHERE target_id IN (SELECT entry_id FROM truth) AND query_id <> target_id
)"""


def _noisy_or(source: str) -> str:
    return f""", limited AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hit_weight DESC, target_id, bitscore, evalue, pident, qcov, tcov) AS pos FROM {source})
  WHERE pos <= 100
), transferred AS (
  SELECT query_id AS entry_id, term, branch, 1 - exp(sum(ln(greatest(1 - hit_weight, 1e-12)))) AS score,
    count(DISTINCT target_id) AS n_hits, max(hit_weight) AS best_hit_weight
  FROM limited JOIN truth ON truth.entry_id = target_id GROUP BY query_id, term, branch
)"""


_TAUS = ", ".join(f"({k}, {t!r}::DOUBLE)" for k, t in enumerate(thresholds(0.01)))
_FMAX = f""", given AS (SELECT entry_id, term, branch, max(score) AS score FROM predictions GROUP BY ALL),
taus(b, tau) AS (VALUES {_TAUS}),
marked AS (SELECT g.*, t.entry_id IS NOT NULL AS tp FROM given g LEFT JOIN truth t USING (entry_id, term, branch)),
sizes AS (SELECT branch, entry_id, count(*) AS n_true FROM truth GROUP BY ALL),
wanted AS (SELECT branch, count(*) AS n_truth_entries, sum(n_true) AS pairs FROM sizes GROUP BY branch),
per_entry AS (
  SELECT branch, entry_id, b, tau, count(*) AS n, count(*) FILTER (WHERE tp) AS tp
  FROM marked JOIN taus ON score >= tau GROUP BY ALL
), macro AS (
  SELECT p.branch, b, tau, avg(tp / n) AS precision, sum(coalesce(tp / n_true, 0)) / any_value(n_truth_entries) AS recall
  FROM per_entry p LEFT JOIN sizes USING (branch, entry_id) JOIN wanted ON wanted.branch = p.branch GROUP BY p.branch, b, tau
), micro AS (
  SELECT p.branch, b, tau, sum(tp) / sum(n) AS precision, sum(tp) / any_value(pairs) AS recall
  FROM per_entry p JOIN wanted ON wanted.branch = p.branch GROUP BY p.branch, b, tau
)"""


def _fmax_rows(average: str, curve: str) -> str:
    return f""", rated AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f FROM {curve}
), best AS (
  SELECT *, row_number() OVER (PARTITION BY branch ORDER BY round(f, 12) DESC, b) AS pos FROM rated
), per_branch AS (
  SELECT x.branch, coalesce(f, 0.0) AS fmax, coalesce(tau, 0.0) AS threshold, coalesce(precision, 0.0) AS precision, coalesce(recall, 0.0) AS recall,
    coalesce(n_truth_entries, 0)::BIGINT AS n_truth_entries,
    (SELECT count(DISTINCT term) FROM truth WHERE truth.branch = x.branch)::BIGINT AS n_truth_terms,
    (SELECT count(*) FROM given WHERE given.branch = x.branch)::BIGINT AS n_prediction_rows
  FROM (VALUES ('MF'), ('BP'), ('CC')) AS x(branch) LEFT JOIN best ON best.branch = x.branch AND pos = 1 LEFT JOIN wanted ON wanted.branch = x.branch
), scores AS (
  SELECT branch, round(fmax, 9) AS fmax, round(threshold, 9) AS threshold, round(precision, 9) AS precision, round(recall, 9) AS recall,
    n_truth_entries, n_truth_terms, n_prediction_rows, round(avg(fmax) OVER (), 9) AS mean_fmax, '{average}' AS average FROM per_branch
)"""


_STATS = """SELECT branch, round(min(score), 9) AS raw_score_min, round(max(score), 9) AS raw_score_max, round(avg(score), 9) AS raw_score_mean,
  count(*) AS prediction_rows FROM predictions GROUP BY branch"""

_REPAIRED = """, base AS (
  SELECT entry_id, p.term, t.branch, max(score) AS score FROM {} p JOIN terms t USING (term) GROUP BY ALL
), repaired AS (
  SELECT entry_id, term, branch, max(score) AS score FROM (
    SELECT * FROM base UNION ALL
    SELECT entry_id, ancestor, ancestor_branch, score FROM base JOIN ancestors ON ancestors.term = base.term
  ) GROUP BY ALL
)"""

_RESOLVED = """, alts AS (SELECT alt_id, term, branch FROM terms WHERE alt_id IS NOT NULL),
resolved AS (
  SELECT l.entry_id, l.term AS source_term, l.branch AS stated, coalesce(t.term, alts.term) AS canonical, coalesce(t.branch, alts.branch) AS branch
  FROM raw_labels l LEFT JOIN terms t ON t.term = l.term LEFT JOIN alts ON alts.alt_id = l.term
)"""

_CLUSTERED = f""", assigned AS (
  SELECT s.entry_id, coalesce(c.cluster_id, 'singleton:' || s.entry_id) AS cluster_id,
    CASE WHEN c.cluster_id IS NULL THEN 'entry_id_singleton' ELSE 'provided_cluster' END AS cluster_source
  FROM sequences s LEFT JOIN clusters c USING (entry_id)
), ranked AS (
  SELECT cluster_id, n, row_number() OVER (ORDER BY n DESC, {_HASH.format("cluster_id")}, cluster_id) AS pos
  FROM (SELECT cluster_id, count(*) AS n FROM assigned GROUP BY cluster_id)
), walk(pos, cluster_id, sizes, groups, fold) AS (
  SELECT 0::BIGINT, '', [0, 0, 0, 0, 0]::BIGINT[], [0, 0, 0, 0, 0]::BIGINT[], -1
  UNION ALL
  SELECT r.pos, r.cluster_id, list_transform(walk.sizes, lambda x, i: CASE WHEN i = pick.f + 1 THEN x + r.n ELSE x END),
    list_transform(walk.groups, lambda x, i: CASE WHEN i = pick.f + 1 THEN x + 1 ELSE x END), pick.f
  FROM walk JOIN ranked r ON r.pos = walk.pos + 1,
    LATERAL (SELECT list_sort(list_transform([0, 1, 2, 3, 4], lambda k: (walk.sizes[k + 1], walk.groups[k + 1], k)))[1][3] AS f) AS pick
)"""

_MANIFEST = """, numbered AS (SELECT *, row_number() OVER (ORDER BY entry_id) - 1 AS i FROM sequences WHERE sequence IS NOT NULL)"""

ORACLE_SQL: dict[str, str] = {
    "src01_parse_header": r"""
WITH h AS (
  SELECT CASE WHEN p_partkey % 2 = 0 THEN 'sp|P' || p_partkey || '|NAME' || p_size || ' OS=Some name OX=' || p_partkey * 7 || ' GN=x'
    ELSE 'P' || p_partkey || ' ' || CASE WHEN p_size > 10 THEN p_size::VARCHAR ELSE 'n/a' END END AS header
  FROM part
)
SELECT header,
  CASE WHEN contains(header, '|') THEN string_split(header, '|')[2] ELSE string_split(header, ' ')[1] END AS entry_id,
  CASE WHEN contains(header, '|') THEN string_split(header, '|')[1] END AS database,
  CASE WHEN contains(header, '|') THEN string_split(string_split(header, '|')[3], ' ')[1] END AS uniprot_name,
  CASE WHEN contains(header, '|') THEN nullif(regexp_extract(header, '(^|\s)OX=(\d+)(\s|$)', 2), '')
    ELSE nullif(regexp_extract(string_split(header, ' ')[2], '^\d+$'), '') END AS taxon_id
FROM h""",
    "prj09_length_bin": f"SELECT {_bins('n_chars')} AS length_bin, count(*) AS n FROM documents GROUP BY 1",
    "prj10_stable_hash": f"SELECT doc_id::VARCHAR AS entry_id, {_HASH.format('doc_id::VARCHAR')} AS hash FROM documents",
    "prj06_prepare_labels": with_views("truth", then=" SELECT * FROM truth"),
    "prj05_branch_from_aspect": with_views("truth", then=" SELECT entry_id, term, branch FROM truth"),
    "joi16_test_taxonomy": """
SELECT doc_id::VARCHAR AS entry_id, lang AS taxon_id, CASE lang WHEN 'en' THEN 'first' WHEN 'fr' THEN 'second' END AS species FROM documents""",
    "agg20_parents": with_views(
        "edges", then=" SELECT child_term, string_agg(DISTINCT parent_term, ',' ORDER BY parent_term) AS parents FROM edges GROUP BY child_term"
    ),
    "agg21_ingestion_issues": """
WITH s AS (SELECT DISTINCT doc_id::VARCHAR AS id FROM documents), k AS (SELECT DISTINCT c_custkey::VARCHAR AS id FROM customer)
SELECT 'sequence_without_taxonomy' AS issue, id FROM s WHERE id NOT IN (SELECT id FROM k)
UNION ALL SELECT 'taxonomy_without_sequence', id FROM k WHERE id NOT IN (SELECT id FROM s)
UNION ALL SELECT DISTINCT 'test_taxon_without_species', lang FROM documents WHERE lang NOT IN ('en', 'fr')""",
    "joi21_align": "SELECT vec_id::VARCHAR AS entry_id, round(embedding[1]::DOUBLE, 6) AS first FROM embeddings WHERE vec_id::VARCHAR IN (SELECT doc_id::VARCHAR FROM documents)",
    "dom15_score_branch": with_views(
        "predictions", "truth", then=_FMAX + _fmax_rows("protein_macro", "macro") + "SELECT * EXCLUDE (mean_fmax) FROM scores WHERE branch = 'BP'"
    ),
    "set06_missing_entries": with_views(
        "supervised", then=" SELECT DISTINCT c_custkey::VARCHAR AS entry_id FROM customer WHERE c_custkey::VARCHAR NOT IN (SELECT entry_id FROM supervised)"
    ),
    "ml08_mean_pool": """
SELECT vec_id::VARCHAR AS entry_id,
  round((embedding[9]::DOUBLE + embedding[17] + embedding[25] + embedding[33] + embedding[41] + embedding[49]) / 6, 6) AS first,
  round((embedding[16]::DOUBLE + embedding[24] + embedding[32] + embedding[40] + embedding[48] + embedding[56]) / 6, 6) AS last FROM embeddings""",
    "agg01_label_frequency": """
WITH labels AS (
  SELECT l_orderkey AS entry_id, 'T' || lpad((l_partkey % 120)::VARCHAR, 5, '0') AS term,
    CASE l_partkey % 120 % 3 WHEN 0 THEN 'MF' WHEN 1 THEN 'BP' ELSE 'CC' END AS branch FROM lineitem WHERE l_linestatus = 'F'
)
SELECT branch, CASE branch WHEN 'MF' THEN 'F' WHEN 'BP' THEN 'P' ELSE 'C' END AS aspect, term,
  count(DISTINCT entry_id) AS n_proteins, count(*) AS n_annotations FROM labels GROUP BY ALL""",
    "agg02_sequence_summary": """SELECT count(*) AS n_sequences, count(DISTINCT doc_id) AS n_unique_entry_ids, min(n_chars)::BIGINT AS min_length,
  round(avg(n_chars), 9) AS mean_length, round(median(n_chars), 9) AS median_length, max(n_chars)::BIGINT AS max_length FROM documents""",
    "prj02_normalize_hits": with_views(
        "hits",
        then=""" SELECT query_id, target_id, NULL::DOUBLE AS score, bitscore, round(evalue, 9) AS evalue, pident, round(qcov, 9) AS qcov, round(tcov, 9) AS tcov FROM hits""",
    ),
    "dom01_hit_weights_bitscore": with_views(
        "hits", then=_BY_BITS + "SELECT query_id, target_id, round(hit_weight, 9) AS hit_weight FROM weighted"
    ),
    "dom01_hit_weights_pident": with_views(
        "hits",
        then=_without("query_id, target_id, evalue, pident, qcov, tcov")
        + _WEIGHTED.format(base=_PIDENT).replace("FROM hits", "FROM hits2")
        + "SELECT query_id, target_id, round(hit_weight, 9) AS hit_weight FROM weighted",
    ),
    "dom01_hit_weights_evalue": with_views(
        "hits",
        then=_without("query_id, target_id, evalue, qcov, tcov")
        + _WEIGHTED.format(base="least(1.0, -log10(greatest(evalue, 1e-300)) / 200)").replace("FROM hits", "FROM hits2")
        + "SELECT query_id, target_id, round(hit_weight, 9) AS hit_weight FROM weighted",
    ),
    "dom01_hit_weights_score": _weights("(CASE WHEN pident > 20 THEN least(1.0, pident / 100) ELSE 0 END)"),
    "dom02_oof_filter": with_views(
        "hits", "folds", then=_BY_BITS + _OOF + "SELECT query_id, target_id, query_fold, target_fold, round(hit_weight, 9) AS hit_weight FROM oof"
    ),
    "dom03_test_filter": with_views(
        "hits", "truth", then=_BY_BITS + _TEST + "SELECT query_id, target_id, round(hit_weight, 9) AS hit_weight FROM kept"
    ),
    "win01_top_hits": with_views(
        "hits",
        then=_BY_BITS
        + """SELECT query_id, target_id, bitscore, round(hit_weight, 9) AS hit_weight FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hit_weight DESC, target_id, bitscore, evalue, pident, qcov, tcov) AS pos FROM weighted)
WHERE pos <= 2""",
    ),
    "agg03_noisy_or": with_views(
        "hits",
        "folds",
        "truth",
        then=_BY_BITS
        + _OOF
        + _noisy_or("oof")
        + "SELECT entry_id, term, branch, round(score, 9) AS score, n_hits, round(best_hit_weight, 9) AS best_hit_weight FROM transferred",
    ),
    "agg05_homology_topk": with_views(
        "hits",
        "folds",
        "truth",
        then=_BY_BITS
        + _OOF
        + _noisy_or("oof")
        + """SELECT entry_id, term, branch, round(score, 9) AS score, n_hits FROM (
  SELECT *, row_number() OVER (PARTITION BY entry_id, branch ORDER BY score DESC, term) AS pos FROM transferred) WHERE pos <= 3""",
    ),
    "agg16_transfer_summary": with_views(
        "hits",
        "truth",
        then=_BY_BITS
        + _TEST
        + _noisy_or("kept")
        + """SELECT (SELECT count(*) FROM kept) AS hit_rows, (SELECT count(DISTINCT query_id) FROM kept) AS query_count, count(*) AS prediction_rows,
  count(DISTINCT entry_id) AS prediction_entries, round(min(score), 9) AS min_score, round(max(score), 9) AS max_score,
  count(*) FILTER (WHERE branch = 'MF') AS prediction_rows_mf, count(*) FILTER (WHERE branch = 'BP') AS prediction_rows_bp,
  count(*) FILTER (WHERE branch = 'CC') AS prediction_rows_cc FROM transferred""",
    ),
    "prj13_edge_classify": with_views(
        "raw_edges",
        "terms",
        then=""" SELECT CASE WHEN relation NOT IN ('is_a', 'part_of') THEN 'relation' WHEN c.term IS NULL THEN 'unknown_child'
    WHEN p.term IS NULL THEN 'unknown_parent' WHEN c.branch <> p.branch THEN 'cross_branch' ELSE 'kept' END AS drop_reason, count(*) AS n
FROM raw_edges LEFT JOIN terms c ON c.term = child_term LEFT JOIN terms p ON p.term = parent_term GROUP BY 1""",
    ),
    "rec01_ancestors": with_views("ancestors", then=" SELECT term, ancestor, distance, term_branch, ancestor_branch FROM ancestors"),
    "dom06_label_closure": with_views(
        "raw_labels",
        "ancestors",
        then=_RESOLVED
        + """, closed AS (
  SELECT entry_id, source_term, canonical AS term, branch, true AS is_direct, 0 AS distance FROM resolved WHERE canonical IS NOT NULL
  UNION ALL
  SELECT entry_id, source_term, ancestor, ancestor_branch, false, distance FROM resolved JOIN ancestors ON ancestors.term = canonical
)
SELECT entry_id, term, CASE branch WHEN 'MF' THEN 'F' WHEN 'BP' THEN 'P' ELSE 'C' END AS aspect, branch, bool_or(is_direct) AS is_direct,
  min(distance)::INTEGER AS distance, count(DISTINCT source_term)::INTEGER AS n_sources FROM closed GROUP BY entry_id, term, branch""",
    ),
    "agg22_label_issues": with_views(
        "raw_labels",
        "terms",
        then=_RESOLVED
        + """SELECT DISTINCT 'alt_id' AS issue, source_term AS term FROM resolved WHERE canonical IS NOT NULL AND canonical <> source_term
UNION SELECT 'obsolete', source_term FROM resolved JOIN all_terms ON all_terms.term = source_term WHERE canonical IS NULL AND is_obsolete
UNION SELECT 'missing', source_term FROM resolved WHERE canonical IS NULL AND source_term NOT IN (SELECT term FROM all_terms)
UNION SELECT 'branch_mismatch', source_term FROM resolved WHERE canonical IS NOT NULL AND stated IS DISTINCT FROM branch""",
    ),
    "seq01_folds_singleton": f"""
SELECT doc_id::VARCHAR AS entry_id,
  ((row_number() OVER (ORDER BY {_HASH.format("'singleton:' || doc_id")}, 'singleton:' || doc_id) - 1) % 5)::INTEGER AS fold,
  {_bins("n_chars")} AS length_bin, lang || '|' || {_bins("n_chars")} AS stratification_key
FROM documents""",
    "seq01_folds_clustered": with_views("sequences", "clusters", then=_CLUSTERED).replace("WITH ", "WITH RECURSIVE ", 1)
    + " SELECT a.entry_id, walk.fold::INTEGER AS fold, a.cluster_id, a.cluster_source FROM assigned a JOIN walk USING (cluster_id)",
    "agg14_fold_validation": with_views(
        "folds",
        then=""", f AS (SELECT *, substr(entry_id, 1, 3) AS cluster_id FROM folds)
SELECT count(DISTINCT entry_id) AS n_entries, count(*) AS n_rows, count(DISTINCT cluster_id) AS n_clusters, count(DISTINCT fold) AS n_folds,
  count(*) - count(DISTINCT entry_id) AS duplicate_entry_count,
  (SELECT count(*) FROM (SELECT cluster_id FROM f GROUP BY cluster_id HAVING count(DISTINCT fold) > 1)) AS cluster_leak_count,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM f GROUP BY fold)) AS largest_fold,
  (SELECT min(n) FROM (SELECT count(*) AS n FROM f GROUP BY fold)) AS smallest_fold FROM f""",
    ),
    "agg15_fold_report": """
WITH labels AS (
  SELECT l_orderkey::VARCHAR AS entry_id, l_partkey % 120 AS term, CASE l_partkey % 120 % 3 WHEN 0 THEN 'MF' WHEN 1 THEN 'BP' ELSE 'CC' END AS branch
  FROM lineitem WHERE l_linestatus = 'F'
)
SELECT (o_custkey % 5)::INTEGER AS fold, branch, count(DISTINCT term) AS n_terms, count(*) AS n_rows
FROM labels JOIN orders ON o_orderkey::VARCHAR = entry_id GROUP BY 1, 2""",
    "agg06_collapse_max": with_views("supervised", then=" SELECT entry_id, term, branch, round(score, 9) AS score FROM " + _COLLAPSED.format("supervised")),
    "agg12_branch_stats": with_views("predictions", then=" " + _STATS),
    "win02_prune_topk": with_views(
        "predictions",
        then=f""" SELECT entry_id, term, branch, round(score, 9) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY entry_id, branch ORDER BY score DESC, term) AS pos FROM {_COLLAPSED.format("predictions")}) WHERE pos <= 2""",
    ),
    "win05_branch_max_norm": with_views(
        "predictions",
        then=f""" SELECT entry_id, term, branch, round(least(1.0, (score / 2) / (max(score / 2) OVER (PARTITION BY branch))), 9) AS score
FROM {_COLLAPSED.format("predictions")}""",
    ),
    "dom07_canonical": with_views(
        "predictions",
        "terms",
        then=" SELECT entry_id, p.term, t.branch, round(max(score), 9) AS score FROM predictions p JOIN terms t USING (term) GROUP BY ALL",
    ),
    "dom08_repair": with_views(
        "predictions",
        "ancestors",
        then=_REPAIRED.format("predictions") + "SELECT entry_id, term, branch, round(score, 9) AS score FROM repaired",
    ),
    "dom09_repair_topk": with_views(
        "predictions",
        "ancestors",
        then=", stated AS (SELECT p.* FROM predictions p JOIN terms t ON t.term = p.term AND t.branch = p.branch)"
        + _REPAIRED.format("stated")
        + """SELECT entry_id, term, branch, round(score, 9) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY entry_id, branch ORDER BY score DESC, term) AS pos FROM repaired) WHERE pos <= 3""",
    ),
    "dom10_blend_mean": with_views(
        "predictions",
        "supervised",
        "terms",
        then=f""" SELECT entry_id, term, t.branch, round(sum(w * score) / 4, 9) AS score FROM (
  SELECT *, 3.0::DOUBLE AS w FROM {_COLLAPSED.format("predictions")} UNION ALL SELECT *, 1.0::DOUBLE FROM {_COLLAPSED.format("supervised")}) x
JOIN terms t USING (term) GROUP BY entry_id, term, t.branch""",
    ),
    "dom11_blend_max": with_views(
        "predictions",
        "supervised",
        then=""", pruned AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entry_id, branch ORDER BY least(1.0, score) DESC, term) AS pos FROM supervised) WHERE pos <= 1
)
SELECT entry_id, term, branch, round(max(score), 9) AS score FROM (
  SELECT entry_id, term, branch, score * 0.5 AS score FROM predictions UNION ALL SELECT entry_id, term, branch, least(1.0, score) * 0.8 FROM pruned
) GROUP BY ALL""",
    ),
    "dom12_calibrate": with_views(
        "predictions",
        then=""" SELECT entry_id, term, branch, round(max(score), 9) AS score FROM (
  SELECT entry_id, term, branch, least(1.0, (score / 2) / (max(score / 2) OVER (PARTITION BY branch))) AS score FROM predictions) GROUP BY ALL""",
    ),
    "dom16_fmax_macro": with_views("predictions", "truth", then=_FMAX + _fmax_rows("protein_macro", "macro") + "SELECT * FROM scores"),
    "dom16_fmax_micro": with_views("predictions", "truth", then=_FMAX + _fmax_rows("micro", "micro") + "SELECT * FROM scores"),
    "agg13_fit_calibration": with_views(
        "predictions",
        "truth",
        then=_FMAX
        + _fmax_rows("micro", "micro")
        + f"""SELECT branch, fmax, raw_score_min, raw_score_max, raw_score_mean, prediction_rows, 'max' AS method, raw_score_max AS scale
FROM scores JOIN ({_STATS}) USING (branch)""",
    ),
    "dom17_submission": with_views(
        "predictions",
        "folds",
        "terms",
        then=f""", best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entry_id, branch ORDER BY score DESC, term) AS pos FROM {_COLLAPSED.format("predictions")}) WHERE pos <= 2
), pairs AS (
  SELECT entry_id, term, max(score) AS score FROM best WHERE entry_id IN (SELECT entry_id FROM folds)
    AND term IN (SELECT term FROM terms WHERE term <> 'T00001') GROUP BY ALL
)
SELECT entry_id, term, round(score, 9) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY score DESC, term) AS pos FROM pairs) WHERE pos <= 3""",
    ),
    "agg18_submission_validation": with_views(
        "supervised",
        "folds",
        "terms",
        then=""", e AS (SELECT DISTINCT c_custkey::VARCHAR AS entry_id FROM customer), t AS (SELECT term FROM terms WHERE term <> 'T00001'), c AS (
  SELECT count(*) AS prediction_rows, count(DISTINCT entry_id) AS unique_entry_ids, count(DISTINCT term) AS unique_terms,
    count(*) - count(DISTINCT (entry_id, term)) AS duplicate_entry_term_count,
    count(*) FILTER (WHERE score IS NULL OR score < 0 OR score > 1) AS invalid_score_count,
    count(*) FILTER (WHERE entry_id NOT IN (SELECT entry_id FROM e)) AS invalid_entry_count,
    count(*) FILTER (WHERE term NOT IN (SELECT term FROM t)) AS invalid_term_count,
    (SELECT count(*) FROM e) AS test_entry_count,
    count(DISTINCT entry_id) FILTER (WHERE entry_id IN (SELECT entry_id FROM e)) AS covered_test_entry_count FROM supervised
)
SELECT *, test_entry_count - covered_test_entry_count AS missing_test_entry_count,
  prediction_rows > 0 AND duplicate_entry_term_count + invalid_score_count + invalid_entry_count + invalid_term_count = 0 AS valid FROM c""",
    ),
    "dom18_manifest": with_views(
        "sequences",
        then=_MANIFEST
        + """SELECT entry_id, 'train' AS split, 'batch_' || lpad((i // 64)::VARCHAR, 5, '0') AS batch_id, i::INTEGER AS row_index, (i % 64)::INTEGER AS row_index_in_batch,
  length(sequence)::INTEGER AS sequence_length, 'artifacts/embeddings/train/batches/batch_' || lpad((i // 64)::VARCHAR, 5, '0') || '.parquet' AS batch_path,
  'artifacts/embeddings/train/shard_' || lpad((i // 64)::VARCHAR, 5, '0') || '.npy' AS shard_path, 'esm2_t33_650M_UR50D' AS model_name,
  'pending' AS status, '' AS completed_at FROM numbered""",
    ),
    "agg17_manifest_summary": with_views(
        "sequences",
        then=_MANIFEST
        + """SELECT count(*) AS n_sequences, count(DISTINCT i // 64) AS n_batches, count(*) FILTER (WHERE i < 192) AS n_complete,
  count(*) FILTER (WHERE i >= 192) AS n_pending, count(DISTINCT i // 64) FILTER (WHERE i >= 192) AS n_pending_batches FROM numbered""",
    ),
    "agg10_select_terms": with_views(
        "truth",
        then=""" SELECT branch, term, n_proteins FROM (
  SELECT branch, term, n_proteins, row_number() OVER (PARTITION BY branch ORDER BY n_proteins DESC, term) AS pos
  FROM (SELECT branch, term, count(DISTINCT entry_id) AS n_proteins FROM truth GROUP BY ALL) WHERE n_proteins >= 5)
WHERE pos <= CASE branch WHEN 'MF' THEN 15 WHEN 'BP' THEN 25 ELSE 10 END""",
    ),
    "agg11_trainable_labels": """
WITH v AS (SELECT label::VARCHAR AS term, (vec_id % 3)::INTEGER AS fold FROM embeddings),
held(held_fold) AS (SELECT DISTINCT fold FROM v UNION ALL SELECT -1)
SELECT 'MF' AS branch, term, held_fold, n_pos, n_rows FROM (
  SELECT term, held_fold, count(*) AS n_pos, (SELECT count(*) FROM v x WHERE x.fold <> held_fold) AS n_rows
  FROM v, held WHERE fold <> held_fold AND term IN (SELECT term FROM v GROUP BY term HAVING count(*) >= 2) GROUP BY ALL)
WHERE n_pos >= 2 AND n_pos < n_rows""",
    "win07_topk_from_vector": """
SELECT entry_id, term, 'MF' AS branch, round(score, 6) AS score FROM (
  SELECT entry_id, 'L' || lpad((i - 1)::VARCHAR, 2, '0') AS term, score, row_number() OVER (PARTITION BY entry_id ORDER BY score DESC, i) AS pos
  FROM (SELECT vec_id::VARCHAR AS entry_id, unnest(embedding)::DOUBLE AS score, generate_subscripts(embedding, 1) AS i FROM embeddings))
WHERE pos <= 5 AND score >= 0.05""",
    "ml03_head_scores": """
WITH z AS (
  SELECT vec_id::VARCHAR AS entry_id, t.k AS k, t.b + list_sum(list_transform(embedding,
    lambda x, i: (x::DOUBLE - (i - 1) / 640.0) / (1 + (i - 1) % 3) * ((((i - 1) * 7 + 3 * t.k) % 11 - 5) / 5.0))) AS z
  FROM embeddings, (VALUES (0, 0.25), (1, -0.5), (2, 0.0), (3, 0.1)) AS t(k, b)
), s AS (SELECT entry_id, k, CAST(1 / (1 + exp(-z)) AS FLOAT) AS score FROM z)
SELECT entry_id, 'H' || k AS term, 'MF' AS branch, round(score::DOUBLE, 6) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY score DESC, k) AS pos FROM s) WHERE pos <= 2 AND score >= 0.3""",
    "ml06_one_hot_heads": """
WITH entries AS (SELECT o_orderkey AS id, floor(o_totalprice)::BIGINT % 4 AS g, o_custkey % 5 AS fold FROM orders),
labels AS (SELECT DISTINCT l_orderkey AS id, l_partkey % 6 AS k FROM lineitem),
kinds AS (SELECT DISTINCT k FROM labels),
cells AS (
  SELECT e.g, e.fold, kinds.k, count(*) AS n, count(l.id) AS pos
  FROM entries e CROSS JOIN kinds LEFT JOIN labels l ON l.id = e.id AND l.k = kinds.k GROUP BY ALL
), others AS (
  SELECT h.fold, c.g, c.k, sum(pos)::DOUBLE AS pos, sum(n - pos)::DOUBLE AS neg
  FROM (SELECT DISTINCT fold FROM entries) h JOIN cells c ON c.fold <> h.fold GROUP BY ALL
), shares AS (
  SELECT fold, g, k, pos / sum(pos) OVER (PARTITION BY fold, k) AS p, neg / sum(neg) OVER (PARTITION BY fold, k) AS q FROM others
)
SELECT e.id::VARCHAR AS entry_id, 'K' || s.k AS term, CASE s.k % 3 WHEN 0 THEN 'MF' WHEN 1 THEN 'BP' ELSE 'CC' END AS branch,
  round((p / (p + q))::FLOAT::DOUBLE, 4) AS score
FROM entries e JOIN shares s ON s.fold = e.fold AND s.g = e.g""",
    "snk09_stored_heads": """
WITH z AS (
  SELECT vec_id, vec_id % 2 AS fold, t.b AS b, c.k AS k, c.k / 4.0 - t.b + list_sum(list_transform(embedding,
    lambda x, i: (x::DOUBLE - (i - 1) / 640.0) / (1 + (i - 1) % 3) * ((((i - 1) * (5 + t.b) + 3 * c.k + vec_id % 2) % 11 - 5) / 5.0))) AS z
  FROM embeddings, (VALUES (0), (1)) AS t(b), (VALUES (0), (1), (2)) AS c(k)
), s AS (SELECT vec_id, fold, b, k, CAST(1 / (1 + exp(-z)) AS FLOAT) AS score FROM z)
SELECT vec_id::VARCHAR AS entry_id, 'H' || fold || k AS term, CASE b WHEN 0 THEN 'MF' ELSE 'BP' END AS branch, round(score::DOUBLE, 6) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, b ORDER BY score DESC, k) AS pos FROM s) WHERE pos <= 2 AND score >= 0.2""",
} | FILE_SQL
