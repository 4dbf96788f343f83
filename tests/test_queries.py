"""Every registered query of the library against DuckDB, at the smallest scale."""

from __future__ import annotations

import os

import duckdb
import pytest

from annofold.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(frame):
    columns = sorted(frame.columns)
    value = lambda v: None if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)
    return columns, sorted((tuple(map(value, r)) for r in frame[columns].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query(spark, duck, name):
    assert plain(catalog.QUERIES[name](spark, SF).toPandas()) == plain(duck.execute(catalog.ORACLE_SQL[name]).df())


def test_cross_validated_heads(spark):
    got = catalog.QUERIES["ml06_cv_heads"](spark, SF).toPandas()
    # Every label that can be trained without an entry's fold gets a score, up to a hundred.
    assert got["score"].between(0, 1).all() and not got.duplicated(["entry_id", "term"]).any()
    assert got.groupby("entry_id").size().max() <= 100


def test_every_query_but_the_heads_has_sql():
    assert set(catalog.QUERIES) - set(catalog.ORACLE_SQL) == {"ml06_cv_heads"}
