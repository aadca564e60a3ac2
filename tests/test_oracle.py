"""Every named result against its independent SQL, on the smallest test tables.

Set TALLY_SF_DIR for another input folder.
"""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from tallywright.plans.catalog import RESULTS

FOLDER = os.environ.get("TALLY_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "orders", "lineitem", "events")
TYPES = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN",
}

# the optional training-data queries have tests of their own
QUERIES = {n: q for n, q in entry_module.queries().items() if n in RESULTS}
SQL = {n: q for n, q in entry_module.oracle_sql().items() if n in RESULTS}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def normal(rows):
    return sorted(
        tuple(repr(v + 0.0) if isinstance(v, float) else f"{type(v).__name__}:{v}" for v in row)
        for row in rows
    )


def test_every_query_has_check_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    expected = duck.sql(SQL[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    spark_types = {f.name: TYPES[f.dataType.simpleString()] for f in result.schema.fields}
    assert spark_types == dict(zip(expected.columns, map(str, expected.types)))
    got = normal(result.select(*columns).collect())
    assert got == normal(expected.select(*[f'"{c}"' for c in columns]).fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 5
