"""Every query against its SQL in DuckDB, on whole tables."""

import math
import os

import duckdb
import pytest

from scholmill import registry

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def plain(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return f"{v:.9g}" if math.isfinite(v) else str(v)
    return f"{float(v):.9g}" if isinstance(v, int) and not isinstance(v, bool) else str(v)


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    df = registry.queries()[name](spark, SF)
    got = table([tuple(r) for r in df.collect()], df.columns)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(registry.oracle_sql()[name])
    want = table(found.fetchall(), [c[0] for c in found.description])
    assert got[0] == want[0]
    assert got[1] and got[1] == want[1]
