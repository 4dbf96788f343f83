"""Column sets, fixed vocabularies and input guards that all operators share."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The three ontology branches and the one-letter aspects of annotation files.
ASPECT_TO_BRANCH = {"F": "MF", "P": "BP", "C": "CC"}
BRANCH_TO_ASPECT = {branch: aspect for aspect, branch in ASPECT_TO_BRANCH.items()}
BRANCHES = ("MF", "BP", "CC")
NAMESPACE_TO_BRANCH = {"molecular_function": "MF", "biological_process": "BP", "cellular_component": "CC"}
RELATIONS = ("is_a", "part_of")

PREDICTION_COLUMNS = ("entry_id", "term", "branch", "score")
SUBMISSION_COLUMNS = ("entry_id", "term", "score")
HIT_COLUMNS = ("query_id", "target_id", "score", "bitscore", "evalue", "pident", "qcov", "tcov")
MANIFEST_COLUMNS = (
    "entry_id",
    "split",
    "batch_id",
    "row_index",
    "row_index_in_batch",
    "sequence_length",
    "batch_path",
    "shard_path",
    "model_name",
    "status",
    "completed_at",
)

PREDICTIONS = T.StructType(
    [
        T.StructField("entry_id", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("branch", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)
# Strings that annotation readers take for a missing value.
NULL_TOKENS = (
    "", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "#N/A", "n/a", "<NA>", "-NaN", "-nan", "#NA",
    "#N/A N/A", "-1.#IND", "1.#IND", "-1.#QNAN", "1.#QNAN",
)


def require_columns(df: DataFrame, columns: Iterable[str], name: str) -> None:
    """Raise ValueError with the sorted names of ``columns`` that ``df`` lacks."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{name} lacks required columns: {', '.join(missing)}")


def fail_if_any(df: DataFrame, message: str, column: str, preview: int = 10) -> None:
    """Raise ValueError if ``df`` has a row; the message shows at most ``preview`` values of ``column``.

    Reads at most that many rows to the driver.
    """
    shown = [str(r[0]) for r in df.select(column).limit(preview).collect()]
    if shown:
        raise ValueError(f"{message}: {', '.join(sorted(shown))}")


def mapped(column: Column, mapping: dict[str, str]) -> Column:
    """Value of a small fixed mapping, null where it has none."""
    pairs: Sequence[Column] = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.element_at(F.create_map(*pairs), column)


def with_branch(df: DataFrame, name: str, strict: bool = True) -> DataFrame:
    """``df`` with a ``branch`` column, taken from ``aspect`` where it has none.

    ``strict`` fails on an aspect outside F, P and C (at run time, in the row); otherwise such
    a row gets a null branch.
    """
    if "branch" in df.columns:
        return df
    if "aspect" not in df.columns:
        raise ValueError(f"{name} needs a branch or an aspect column")
    branch = mapped(F.col("aspect"), ASPECT_TO_BRANCH)
    if strict:
        told = F.concat(F.lit(f"{name} has an unknown aspect: "), F.col("aspect"))
        branch = F.when(F.col("aspect").isNull() | branch.isNotNull(), branch).otherwise(F.raise_error(told).cast("string"))
    return df.withColumn("branch", branch)


def not_missing(*columns: str) -> Column:
    """All of ``columns`` are non-null."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out
