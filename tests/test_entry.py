"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from testbed.binding import SEGMENTS  # noqa: E402
from testbed.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("supplier", "customer", "orders", "lineitem", "events", "documents", "labels", "embeddings")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_of_the_jobs_has_an_oracle():
    assert QUERIES.keys() <= contract.queries().keys()
    assert QUERIES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


def test_the_tenants_of_the_binding_are_those_of_the_table(spark):
    found = spark.read.parquet(f"{SF_DIR}/customer.parquet").select("c_mktsegment").distinct().collect()
    assert sorted(r[0] for r in found) == sorted(SEGMENTS)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_its_oracle(spark, database, name):
    result = contract.queries()[name](spark, SF_DIR)
    relation = database.sql(contract.oracle_sql()[name])
    columns = sorted(result.columns)
    assert columns == sorted(relation.columns)
    order = [relation.columns.index(c) for c in columns]
    expected = sorted(tuple(row[i] for i in order) for row in relation.fetchall())
    assert sorted(tuple(row) for row in result.select(*columns).collect()) == expected


def test_flagship_is_not_empty(spark):
    assert contract.entry(spark).count() == 360
