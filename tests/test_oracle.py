"""Every query with an SQL twin gives the same rows in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = ("documents", "labels", "pages", "conversations")
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = _sorted([tuple(row[c] for c in columns) for row in df.collect()])
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = _sorted([tuple(row[i] for i in order) for row in result.fetchall()])
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_names_are_paired():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
