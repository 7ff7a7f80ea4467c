"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registry  # noqa: E402

TABLES = ("region", "nation", "supplier", "orders", "lineitem", "events", "documents")
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE",
}
OPTIONAL = {*registry._extra("QUERIES")}
SQL = {name: text for name, text in registry.oracle_sql().items() if name not in OPTIONAL}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_registry_is_consistent():
    assert set(SQL) <= set(registry.queries())
    assert set(registry.queries()) - set(SQL) - OPTIONAL == {
        "temperature_predictions", "precipitation_classes", "weather_clusters",
        "weather_cluster_statistics", "ml_summary", "ml_predictions",
    }


def test_entry_is_the_enrichment(spark):
    assert registry.entry(spark).count() == 6954


@pytest.mark.parametrize("name", SQL)
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    df = registry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = duck.execute(f"SELECT {quoted} FROM ({SQL[name]}) q")
    kinds = dict(df.dtypes)
    described = {c[0]: str(c[1]) for c in expected.description}
    got = sorted(repr(tuple(row)) for row in df.select(*columns).collect())
    assert got == sorted(repr(row) for row in expected.fetchall())
    assert len(got) > 0
    types = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert sorted(described) == columns
    assert {c: TYPES[kinds[c]] for c in columns} == types
