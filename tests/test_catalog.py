"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from wardlight.plans import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SQL = entry_point.oracle_sql()
QUERIES = entry_point.queries()


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def shown(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return f"{float(value):.6f}" if isinstance(value, (int, float)) else str(value)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(shown(r[i]) for i in order) for r in records),
        key=lambda r: tuple((v is not None, v or "") for v in r),
    )


def test_every_statement_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, database, folder, name):
    got = QUERIES[name](spark, folder)
    result = database.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, got.collect()) == rows(columns, result.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_prepared_table_stored_once(spark, folder, monkeypatch):
    """A table that need not be dealt anew is written once, not once more as it is."""
    stored = []
    monkeypatch.setattr(catalog, "materialize", lambda df: stored.append(df) or df)
    monkeypatch.setattr(catalog.training, "spread", lambda df: df)
    monkeypatch.setattr(catalog, "_PREPARED", {})
    catalog._prepared(spark, folder)
    assert len(stored) == 1
