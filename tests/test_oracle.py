"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("customer part orders lineitem events documents embeddings pages labels").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(got.columns) == sorted(rel.columns)
    assert _norm(got.columns, got.collect()) == _norm(rel.columns, rel.fetchall())


def test_every_query_of_the_catalog_has_an_oracle():
    assert not {q for q in E.queries() if q.startswith("q_")} - set(E.oracle_sql())


def test_entry_smoke(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["R2"] > 0.9
