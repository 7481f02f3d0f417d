"""A few registered queries against their SQL; ``check.py`` runs all of them."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import rows_of

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def test_every_query_has_its_sql():
    from workload.queries import QUERIES

    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", ["overrides", "code_facets", "change_log", "near_duplicates", "annotate", "language_id"])
def test_query(spark, duck, name):
    got = entry_points.queries()[name](spark, SF_DIR).toPandas()
    want = duck.execute(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
