"""Registered queries against DuckDB at the smallest scale, and the registry itself."""

from __future__ import annotations

import os

import duckdb
import pytest

from annofold.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    plain = lambda f: sorted((tuple(None if v != v else str(v) for v in r) for r in f[columns].astype(object).itertuples(index=False)), key=repr)
    assert plain(got) == plain(want)


def test_one_query_an_operator():
    numbers = [int(n.split("_")[0].removeprefix("op")) for n in queries.QUERIES]
    assert numbers == sorted(set(numbers)) and set(numbers) >= set(range(1, 11))
