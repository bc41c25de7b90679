"""Every query with SQL against DuckDB on the smallest tables, the others for rows and a stable schema."""

from __future__ import annotations

import duckdb
import pytest

from tessera.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _plain(v):
    return round(float(v), 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, oracle, name):
    got = registry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted((tuple(_plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    found = oracle.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(_plain(row[names.index(c)]) for c in columns) for row in found.fetchall()), key=repr)
    assert rows == want


def test_every_query_names_operators():
    assert all(e.ops for e in registry.entries().values())
