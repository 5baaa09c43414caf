"""The registered queries against their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from checks.oracles import ORACLES
from checks.queries import QUERIES
from compare import SQL_TYPES, _rows

DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DIR.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = entry.queries()[name](spark, str(DIR))
    oracle = duck.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in oracle.description]
    assert {column[0]: str(column[1]) for column in oracle.description} == {
        name: SQL_TYPES.get(kind) for name, kind in result.dtypes}
    assert _rows(result.columns, [tuple(row) for row in result.collect()]) == _rows(columns, oracle.fetchall())
