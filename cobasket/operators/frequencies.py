"""How often users, orders and items occur."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cobasket.operators.lookup import look_up


def items_per_link(interactions: DataFrame, distinct_rows: bool = False) -> DataFrame:
    """Purchase mode: distinct items of each user, ``(client, link, ufrq)``.

    Rows known to be distinct are only counted, which saves an exchange.
    """
    count = F.count if distinct_rows else F.countDistinct
    return interactions.groupBy("client", "link").agg(count("item").alias("ufrq"))


def items_per_buyer(interactions: DataFrame) -> DataFrame:
    """Order mode: each order with the item total of its *buyer*, ``(client, user_id, link, ufrq)``.

    Orders are counted first and summed up to users, so one exchange of the rows serves both sides
    of the join and a busy buyer never gathers row by row.
    """
    per_order = interactions.groupBy("client", "user_id", "link").agg(F.count("item").alias("n_items"))
    # Always true, but it keeps the count in use on both sides of the join. Unused, it would be
    # dropped from one of them, which would then be computed from the source anew. A test of the plan
    # holds this.
    per_order = per_order.filter(F.col("n_items") >= 0)
    per_buyer = per_order.groupBy("client", "user_id").agg(F.sum("n_items").alias("ufrq"))
    return look_up(per_order, per_buyer, ["client", "user_id"]).select("client", "user_id", "link", "ufrq")


def links_per_item(interactions: DataFrame, distinct_rows: bool = False) -> DataFrame:
    """Distinct links of each item, ``(client, item, freq)``. A null link is not counted.

    Rows known to be distinct are only counted, which saves an exchange.
    """
    count = F.count if distinct_rows else F.countDistinct
    return interactions.groupBy("client", "item").agg(count("link").alias("freq"))
