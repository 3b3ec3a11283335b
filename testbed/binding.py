"""The benchmark tables seen as catalog and orders of five tenants.

A tenant is a market segment, a user is a customer and a product is a supplier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Lines per task of the join that builds the orders.
LINES_PER_TASK = 250_000

# The market segments of the public benchmark schema.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenant lists every supplier; the last digit of the key decides the status."""
    digit = F.col("s_suppkey") % 10
    status = F.when(digit <= 6, "AVAILABLE").when(digit <= 8, "UNAVAILABLE").otherwise("REMOVED")
    return table(spark, sf_dir, "supplier").select(
        F.explode(F.array(*[F.lit(s) for s in SEGMENTS])).alias("client"),
        F.col("s_suppkey").cast("string").alias("product_id"),
        status.alias("status"),
    )


def _lines(spark: SparkSession, sf_dir: str, per_task: int = LINES_PER_TASK) -> DataFrame:
    """Lines with their order and customer, joined at most about ``per_task`` lines to a task.

    Adaptive execution merges partitions by their compressed bytes. Lines shrink to 15 bytes each, so a merged task would
    sort millions of them, and whatever hashes them next would hold as many rows. A given number of partitions isn't merged.
    """
    lines = table(spark, sf_dir, "lineitem")
    bought = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    tasks = -(-lines.count() // per_task)  # from the footers of the files
    if tasks > spark.sparkContext.defaultParallelism:
        lines, bought = lines.repartition(tasks, "l_orderkey"), bought.repartition(tasks, "o_orderkey")
    return lines.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))


def _item(product_id: Column) -> Column:
    product = F.struct(
        product_id.cast("string").alias("id"),
        F.col("l_extendedprice").alias("price"),
        F.create_map().cast("map<string,string>").alias("specs"),
    )
    return F.struct(product.alias("product"))


def _order_columns() -> list[Column]:
    return [
        F.col("c_mktsegment").alias("client"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("total"),
    ]


def order_lines(spark: SparkSession, sf_dir: str, product: str = "l_suppkey") -> DataFrame:
    """Orders delivered line by line: one event per line, holding that one item.

    Exploding gives the same rows as :func:`nested_orders` gives, without first gathering orders
    only to take them apart again.
    """
    return _lines(spark, sf_dir).select(*_order_columns(), F.array(_item(F.col(product))).alias("items"))


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per order, with all its items. An order is one record of the format, whatever its length."""
    return (
        _lines(spark, sf_dir)
        .select(*_order_columns(), _item(F.col("l_suppkey")).alias("line"))
        .groupBy("client", "order_id", "user_id", "date", "total")
        .agg(F.collect_list("line").alias("items"))
        .select("client", "order_id", "user_id", "items", "date", "total")
    )
