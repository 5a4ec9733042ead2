import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from nestloom.suite.queries import REGISTRY

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_of_the_library_has_its_counterpart():
    assert set(SQL) <= set(QUERIES) and set(REGISTRY) <= set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_lookups_follow_the_data(spark, tmp_path):
    """The same query after a table changed in the folder gives the new answer."""
    folder = str(tmp_path)
    for name in ("customer", "supplier", "orders", "lineitem", "part", "nation"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    before = REGISTRY["lookup_point"](spark, folder).first()
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    orders.where("o_custkey <> 3").write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    after = REGISTRY["lookup_point"](spark, folder).first()
    assert before.TotalOrders == orders.where("o_custkey = 3").count() > 0 and not after.TotalOrders
