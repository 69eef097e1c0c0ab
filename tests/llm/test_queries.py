"""The registered corpus queries against DuckDB, whole tables of the smallest size."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from wardlight.llm import queries as corpus


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def shown(rows):
    return sorted(
        tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in row) for row in rows
    )


def test_registered():
    names = set(entry_point.queries())
    assert set(corpus.QUERIES) <= names
    for number in range(1, 14):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(corpus.ORACLE_SQL))
def test_query_equals_sql(spark, database, folder, name):
    got = corpus.QUERIES[name](spark, folder)
    result = database.execute(corpus.ORACLE_SQL[name])
    columns = sorted(d[0] for d in result.description)
    assert sorted(got.columns) == columns
    want = result.df()[columns].astype(object)
    want = want.where(want.notna(), None)
    assert shown(got.select(columns).collect()) == shown(want.itertuples(index=False))
