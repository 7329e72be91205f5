"""Every registered query against its SQL twin, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tidegrid.plans import registry

FOLDER = Path("/root/testdata/sf0.001")
QUERIES = {name: run for name, run in entry.queries().items() if name in registry.QUERIES}
ORACLES = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(zip(*[map(repr, table[n].to_pylist()) for n in names]))


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    result = QUERIES[name](spark, str(FOLDER)).toArrow()
    expected = database.execute(ORACLES[name]).to_arrow_table()
    assert rows(result) == rows(expected)
    assert result.num_rows > 0


def test_entry(spark):
    assert entry.entry(spark).columns[-3:] == ["position", "value", "amount"]
