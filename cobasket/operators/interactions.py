"""From catalogs and nested orders to flat interactions ``(client, link, item)``.

A *link* is what ties items together: the user in purchase mode, the order in order mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cobasket.operators.lookup import look_up
from cobasket.operators.membership import possibly_in

# Catalog states of items that may be suggested.
KEPT_STATUSES = ("AVAILABLE", "UNAVAILABLE")


def sellable_items(products: DataFrame) -> DataFrame:
    """Items of the catalog that are, or may again be, on sale. Repeated products stay repeated."""
    return products.filter(F.col("status").isin(*KEPT_STATUSES)).select(
        "client", F.col("product_id").alias("item")
    )


def purchase_interactions(events: DataFrame) -> DataFrame:
    """One row per bought item, linked by user. Orders without items vanish.

    Exploding the id path rather than the item structs keeps prices and specs out of the scan.
    """
    return events.select("client", F.col("user_id").alias("link"), F.explode("items.product.id").alias("item"))


def order_interactions(events: DataFrame) -> DataFrame:
    """One row per bought item, linked by the raw order id, with the buyer kept alongside."""
    return events.select(
        "client", "user_id", F.col("order_id").alias("link"), F.explode("items.product.id").alias("item")
    )


def order_key(user_id: Column, order_id: Column) -> Column:
    """Order identity across users: two users may use the same order id.

    The length prefix makes the text unambiguous, unlike plain concatenation, where user 1 with
    order 23 equals user 12 with order 3. Null when either part is null.
    """
    return F.concat(F.length(user_id).cast("string"), F.lit(":"), user_id, F.lit(":"), order_id)


def with_order_key(interactions: DataFrame) -> DataFrame:
    """Replace the raw order id in ``link`` by :func:`order_key`."""
    return interactions.withColumn("link", order_key(F.col("user_id"), F.col("link")))


def complete(interactions: DataFrame, *columns: str) -> DataFrame:
    """Rows without a null in ``columns``; the others take no part in any join.

    Stated once, ahead of the branches that count rows: else the optimizer adds such conditions to
    some branches only, and these no longer share a scan. Each is a plain predicate, as the
    optimizer would write it; ``dropna`` has a form of its own.
    """
    for column in columns:
        interactions = interactions.filter(F.col(column).isNotNull())
    return interactions


def valid_interactions(interactions: DataFrame, items: DataFrame, catalog_bits: int = 0) -> DataFrame:
    """Distinct interactions whose item is in ``items``; a product listed twice does no harm.

    Duplicates go first. That exchange hashes the whole row, so neither a busy link nor a popular
    item gathers in one task, and map-side combining shrinks repeated rows before they move. A small
    catalog is then broadcast and Catalyst moves the semi-join below the exchange; a large one is
    joined by (client, item), where adaptive execution may split a popular item because nothing
    above depends on that partitioning. ``catalog_bits``, if any, is the size of a Bloom filter of the
    items, by which most rows of other items leave ahead of the first exchange.
    """
    if catalog_bits:
        interactions = possibly_in(interactions, items, ["client", "item"], catalog_bits)
    valid = look_up(interactions.distinct(), items.select("client", "item"), ["client", "item"], "left_semi")
    return valid.select(*interactions.columns)


def prune_interactions(
    interactions: DataFrame,
    link_freq: DataFrame,
    item_freq: DataFrame,
    max_user_events: int,
    distinct_rows: bool = False,
) -> DataFrame:
    """Drop items seen in one link only, links with one item, and links above the cap.

    One pass: frequencies are those given, not recomputed after pruning, one row per key. Links above
    the cap are dropped whole. Both filters are inner joins with such tables: semi-joins would be moved
    below the distinct on some paths only, and the source read once per path. The distinct comes
    first (see :func:`valid_interactions` for why it does). Rows known to be distinct skip it.
    """
    links = link_freq.filter(F.col("ufrq").between(2, max_user_events)).select("client", "link")
    items = item_freq.filter(F.col("freq") > 1).select("client", "item")
    rows = interactions.select("client", "link", "item")
    rows = rows if distinct_rows else rows.distinct()
    rows = look_up(rows, links, ["client", "link"])
    return look_up(rows, items, ["client", "item"]).select("client", "link", "item")
