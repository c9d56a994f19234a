import glob
import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import same
from siltstone.workload.oracle import ORACLE
from siltstone.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables not found")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    outcome = same(queries()[name](spark, FOLDER).toPandas(), db.sql(oracle_sql()[name]).df())
    assert outcome.startswith("ok"), outcome


def test_entry(spark):
    assert entry(spark).columns == ["term", "points", "class"]
