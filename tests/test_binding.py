"""How the benchmark tables are joined to orders."""

import pytest
from pyspark.sql import functions as F

from testbed.binding import _lines

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def small_tables(spark, tmp_path):
    spark.range(50).selectExpr("id AS c_custkey", "'BUILDING' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    orders = spark.range(1000).selectExpr("nullif(id, 7) AS o_orderkey", "id % 60 AS o_custkey")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.range(4000).selectExpr("nullif(id % 1100, 9) AS l_orderkey", "id AS l_suppkey")
    lines.union(lines.limit(100)).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("conf", [{}, NO_BROADCAST], ids=["broadcast", "shuffle"])
def test_lines_are_spread_by_their_number(spark, small_tables, conf):
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        joined = _lines(spark, small_tables, per_task=200)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        plain = _lines(spark, small_tables)
        assert sorted(map(repr, joined.collect())) == sorted(map(repr, plain.collect()))
    finally:
        for key in conf:
            spark.conf.unset(key)
    # By bytes alone, these few lines would be merged into next to no tasks.
    assert len(sizes) > 15 and max(sizes) < 400
