"""Queries with SQL against DuckDB, on whole tables."""

import duckdb
import pytest

from scholmill.llm import registry
from tests.test_oracles import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, name):
    df = registry.queries()[name](spark, SF)
    got = table([tuple(r) for r in df.collect()], df.columns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.execute(registry.oracle_sql()[name])
    want = table(found.fetchall(), [c[0] for c in found.description])
    assert got[0] == want[0]
    assert got[1] and got[1] == want[1]
