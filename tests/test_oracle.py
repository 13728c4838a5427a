"""Every registered query against its SQL counterpart, row by row."""

import os

import pytest

from teletally import catalog, oracle
from tests.compare import duck, duck_rows, duck_types, spark_rows, spark_types

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.all_queries()
SQL = oracle.all_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, key):
    con, df = duck(FOLDER), QUERIES[key](spark, FOLDER)
    found = spark_rows(df)
    assert found[1], "no rows"
    assert found == duck_rows(con, SQL[key])
    assert spark_types(df) == duck_types(con, SQL[key])
