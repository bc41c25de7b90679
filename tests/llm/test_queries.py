"""The registered queries: one per operator, SQL where there is some, edge tables, and no limits on the way."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__
from tessera.llm import queries

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = __spark_entry__.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) < set(names) and "pipeline" in names and set(queries.ORACLE) < set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(repr, found.fetchall()))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, name, tmp_path):
    for t in ("documents", "pages", "embeddings", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0
