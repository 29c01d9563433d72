import os

import pytest

from oracle import connect, differences
from tidemark.session import clean_scratch
from workload import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, duck, name):
    assert differences(spark, duck, name, FOLDER) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_nothing_is_left_behind(spark):
    """No temp view, and after a clean-up neither a database nor a folder of the queries."""
    clean_scratch(spark)
    before = {r.name for r in spark.catalog.listDatabases()}
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    folders = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    for name in ("evolved_table", "stream_upsert_latest", "number_batches"):
        QUERIES[name](spark, FOLDER).count()
    assert not [t.name for t in spark.catalog.listTables() if t.isTemporary]
    clean_scratch(spark)
    assert {r.name for r in spark.catalog.listDatabases()} == before
    assert set(os.listdir(shared)) <= folders
