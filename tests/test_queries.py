"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from docweir import registry

SF = "/root/testdata/sf0.001"


def cells(rows):
    return sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    ours = registry.QUERIES[name](spark, SF)
    theirs = duck.sql(registry.ORACLE_SQL[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    assert cells(ours.select(*columns).collect()) == cells(theirs.project(listed).fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
