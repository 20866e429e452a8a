"""Every registered query against its SQL, values and types, on the generated tables."""

import os

import duckdb
import pytest

from querybook.duck_sql import ORACLE
from querybook.spark_queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "double": "DOUBLE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no generated tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        connection.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF_DIR}/{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.sql(ORACLE[name])
    assert sorted((column, TYPES.get(kind, kind.upper())) for column, kind in ours.dtypes) == sorted(
        zip(theirs.columns, map(str, theirs.types))
    )
    rows = [tuple(row) for row in ours.select(*theirs.columns).collect()]
    expected = theirs.fetchall()
    assert expected, "an empty comparison proves nothing"
    if name.startswith("ord"):
        assert rows == expected
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))
