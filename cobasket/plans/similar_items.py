"""The two suggestion jobs as one lazy plan each.

The operators of ``cobasket.operators`` state every step on its own. Here they are fused so that
each exchange of rows is used for all it can give:

* the source is read once; its distinct rows feed the item frequencies and the main path;
* the item frequency and the catalog meet at item level, and one join brings both to the rows;
* the rows are partitioned and sorted by buyer once, which gives the buyer's total and the baskets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cobasket.operators.cooccurrence import count_pairs, mirrored, numbered_items
from cobasket.operators.documents import suggestion_documents, result_arrays
from cobasket.operators.interactions import (
    complete,
    order_interactions,
    purchase_interactions,
    sellable_items,
    with_order_key,
)
from cobasket.operators.lookup import look_up
from cobasket.operators.membership import possibly_in
from cobasket.operators.ranking import ranked_similar
from cobasket.tuning import ORDER_TUNING, PURCHASE_TUNING, Tuning


def item_frequencies(rows: DataFrame, items: DataFrame) -> DataFrame:
    """``(client, item, freq)`` of the catalog's items in distinct interactions.

    The catalog is joined to the frequencies, one row per item, with an inner join on distinct keys.
    A semi-join of the rows would say the same, but Catalyst moves it below the distinct on one path
    only and then has to read the source twice.
    """
    freq = rows.groupBy("client", "item").agg(F.count("link").alias("freq"))
    return freq.join(items.distinct(), ["client", "item"])


def buyers_within_cap(rows: DataFrame, buyer: str, cap: int) -> DataFrame:
    """Add each buyer's total ``ufrq`` and drop the buyers with fewer than two or more than ``cap`` rows.

    Buyers over the cap are found by counting, which combines before it moves anything, and taken out
    by an anti-join with those few; so an account with a large share of all rows leaves before its rows
    are gathered, and no later task holds more than ``cap`` rows of a buyer. Rows are then exchanged by
    buyer and sorted once, in the order in which baskets are built.
    """
    over = rows.groupBy("client", buyer).agg(F.count(F.lit(1)).alias("total")).filter(F.col("total") > cap)
    kept = look_up(rows, over, ["client", buyer], "left_anti").select(*rows.columns)
    order = list(dict.fromkeys(("client", buyer, "link", "freq", "number")))
    by_buyer = kept.repartition("client", buyer).sortWithinPartitions(*order)
    total = F.count(F.lit(1)).over(Window.partitionBy("client", buyer))
    return by_buyer.withColumn("ufrq", total).filter(F.col("ufrq") >= 2)


def _edges(interactions: DataFrame, products: DataFrame, buyer: str, tuning: Tuning) -> DataFrame:
    cap = tuning.max_user_events
    items = sellable_items(products)
    known = complete(interactions, "client", buyer, "item")
    if tuning.catalog_bits:
        known = possibly_in(known, items, ["client", "item"], tuning.catalog_bits)
    known = known.distinct()
    freq = numbered_items(item_frequencies(known, items))
    rows = look_up(known, freq, ["client", "item"]).drop("item")
    rows = buyers_within_cap(rows, buyer, cap)
    # A pair shares at most as many links as its rarer item has, and its weight is at most that too.
    enough = max(tuning.min_amf, tuning.min_nmf)
    rows = rows.filter(F.col("link").isNotNull() & (F.col("freq") > 1) & (F.col("freq") >= F.lit(float(enough))))
    return count_pairs(
        rows,
        freq,
        tuning.min_amf,
        tuning.min_nmf,
        link_keys=tuple(dict.fromkeys(("client", buyer, "link"))),
        longest_link=cap,
        buckets=tuning.pair_buckets,
    )


def purchase_edges(products: DataFrame, events: DataFrame, tuning: Tuning = PURCHASE_TUNING) -> DataFrame:
    """Item pairs bought by the same users."""
    return _edges(purchase_interactions(events), products, "link", tuning)


def order_edges(products: DataFrame, events: DataFrame, tuning: Tuning = ORDER_TUNING) -> DataFrame:
    """Item pairs bought in the same orders."""
    return _edges(with_order_key(order_interactions(events)), products, "user_id", tuning)


def _ranked(edges: DataFrame, tuning: Tuning) -> DataFrame:
    return ranked_similar(mirrored(edges), tuning.alpha, tuning.adjust, tuning.max_similar)


def purchase_similar_items(products: DataFrame, events: DataFrame, tuning: Tuning = PURCHASE_TUNING) -> DataFrame:
    """Flat suggestions, one row per item and suggested item, by shared users."""
    return _ranked(purchase_edges(products, events, tuning), tuning)


def order_similar_items(products: DataFrame, events: DataFrame, tuning: Tuning = ORDER_TUNING) -> DataFrame:
    """Flat suggestions, one row per item and suggested item, by shared orders."""
    return _ranked(order_edges(products, events, tuning), tuning)


def purchase_suggestions(products: DataFrame, events: DataFrame, tuning: Tuning = PURCHASE_TUNING) -> DataFrame:
    """Suggestion documents of purchase mode."""
    return suggestion_documents(result_arrays(purchase_similar_items(products, events, tuning)), tuning)


def order_suggestions(products: DataFrame, events: DataFrame, tuning: Tuning = ORDER_TUNING) -> DataFrame:
    """Suggestion documents of order mode."""
    return suggestion_documents(result_arrays(order_similar_items(products, events, tuning)), tuning)
