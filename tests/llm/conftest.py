from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from data import DOC_DDL, documents  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(documents(), DOC_DDL)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same rows with columns named like those that the operators make."""
    from pyspark.sql import functions as F

    names = ("row", "at", "key", "doc", "n", "word", "line", "shard", "length", "site", "t", "w", "h", "component", "score", "ids", "rank", "part", "class")
    return docs.withColumns({name: F.lit("x") for name in names})


@pytest.fixture()
def duck():
    """Run DuckDB SQL over pandas tables; sorted rows of the columns named."""

    def run(sql, columns, **tables):
        con = duckdb.connect()
        for name, frame in tables.items():
            con.register(name, frame)
        return sorted((tuple(r) for r in con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()), key=repr)

    return run
