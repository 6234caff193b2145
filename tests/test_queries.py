"""Every registered query against the same question put to DuckDB."""

import glob
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from clusterloom.plans.oracles import ORACLES
from clusterloom.plans.queries import QUERIES
from tests.conftest import DATA

SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def in_order(rows, names):
    """Rows with columns by name, as an unordered collection."""
    places = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(row[i]) for i in places) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = queries()[name](spark, DATA)
    rows = [tuple(r) for r in result.collect()]
    assert rows
    asked = duck.execute(oracle_sql()[name])
    names = [column[0] for column in asked.description]
    expected = asked.fetchall()
    types = {column[0]: str(column[1]) for column in asked.description}
    assert {name: SQL_TYPES[kind] for name, kind in result.dtypes} == types
    assert in_order(rows, result.columns) == in_order(expected, names)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert {r["feature"] for r in rows} == {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
    assert {(r["clusters"], r["astray"]) for r in rows} == {(5, 0)}
