from pyspark.sql import functions as F

from cobasket.operators.frequencies import items_per_buyer, items_per_link, links_per_item
from cobasket.operators.interactions import (
    order_interactions,
    prune_interactions,
    purchase_interactions,
    sellable_items,
    valid_interactions,
    with_order_key,
)
from tests.helpers import catalog, events, rows

TRIPLES = "client string, link string, item string"


def test_sellable_items_keeps_two_statuses_and_repeats(spark):
    products = catalog(spark, [("A", "AVAILABLE"), ("A", "UNAVAILABLE"), ("B", "REMOVED"), ("C", None)])
    assert rows(sellable_items(products)) == [("c1", "A"), ("c1", "A")]


def test_explode_drops_null_and_empty_item_lists_but_not_null_products(spark):
    data = events(spark, [("u1", "o1", ["A", "A", None]), ("u2", "o2", None), ("u3", "o3", []), (None, "o4", ["B"])])
    assert rows(purchase_interactions(data)) == [
        ("c1", "u1", "A"),
        ("c1", "u1", "A"),
        ("c1", "u1", None),
        ("c1", None, "B"),
    ]


def test_order_key_is_unambiguous_and_null_when_a_part_is(spark):
    data = events(spark, [("u1", "1x", ["A"]), ("u11", "x", ["A"]), (None, "o", ["A"]), ("u", None, ["A"])])
    links = [r[1:3] for r in rows(with_order_key(order_interactions(data)))]
    assert sorted(links, key=repr) == sorted(
        [("u1", "2:u1:1x"), ("u11", "3:u11:x"), (None, None), ("u", None)], key=repr
    )


def test_orders_of_different_users_do_not_merge(spark):
    data = events(spark, [("u1", "1x", ["A"]), ("u11", "x", ["B"])])
    assert with_order_key(order_interactions(data)).select("link").distinct().count() == 2


def test_valid_interactions_neither_multiply_nor_keep_nulls(spark):
    items = sellable_items(catalog(spark, [("A", "AVAILABLE"), ("A", "UNAVAILABLE"), ("B", "REMOVED")]))
    data = spark.createDataFrame(
        [("c1", "u1", "A"), ("c1", "u1", "A"), ("c1", "u1", "B"), ("c1", "u1", None), ("c2", "u1", "A"), ("c1", None, "A")],
        TRIPLES,
    )
    assert rows(valid_interactions(data, items)) == [("c1", "u1", "A"), ("c1", None, "A")]


def test_valid_interactions_keep_extra_columns_in_place(spark):
    data = with_order_key(order_interactions(events(spark, [("u1", "o1", ["A", "A"])])))
    items = sellable_items(catalog(spark, {"A": "AVAILABLE"}))
    assert rows(valid_interactions(data, items)) == [("c1", "u1", "2:u1:o1", "A")]


def test_link_and_item_frequencies_count_distinct_values(spark):
    data = spark.createDataFrame(
        [("c1", "u1", "A"), ("c1", "u1", "A"), ("c1", "u1", "B"), ("c1", None, "B"), ("c2", "u1", "A")], TRIPLES
    )
    assert rows(items_per_link(data)) == [("c1", "u1", 2), ("c1", None, 1), ("c2", "u1", 1)]
    assert rows(links_per_item(data)) == [("c1", "A", 1), ("c1", "B", 1), ("c2", "A", 1)]


def test_buyer_totals_cover_all_orders_and_those_without_id(spark):
    data = spark.createDataFrame(
        [
            ("c1", "u1", "k1", "A"),
            ("c1", "u1", "k2", "A"),
            ("c1", "u1", "k2", "B"),
            ("c1", "u1", None, "C"),
            ("c1", None, None, "A"),
        ],
        "client string, user_id string, link string, item string",
    )
    assert rows(items_per_buyer(data)) == [("c1", "u1", "k1", 4), ("c1", "u1", "k2", 4), ("c1", "u1", None, 4)]
    assert rows(links_per_item(data)) == [("c1", "A", 2), ("c1", "B", 1), ("c1", "C", 0)]


def _bounds(spark, sizes):
    data = [("c1", user, f"i{n}") for user, size in sizes.items() for n in range(size)]
    return spark.createDataFrame(data, TRIPLES)


def test_cap_is_inclusive_and_drops_links_whole(spark):
    data = _bounds(spark, {"at": 5, "over": 6, "one": 1, "two": 2})
    kept = prune_interactions(data, items_per_link(data), links_per_item(data), 5)
    assert rows(kept.groupBy("link").count()) == [("at", 5), ("two", 2)]


def test_pruning_drops_single_link_items_and_does_not_recount(spark):
    data = spark.createDataFrame(
        [("c1", "u1", "A"), ("c1", "u1", "B"), ("c1", "u2", "A"), ("c1", "u2", "A")], TRIPLES
    )
    kept = prune_interactions(data, items_per_link(data), links_per_item(data), 10)
    # u2 has one item and goes, B has one link and goes; A keeps its frequency of 2 and stays alone.
    assert rows(kept) == [("c1", "u1", "A")]


def test_pruning_returns_distinct_rows(spark):
    data = spark.createDataFrame([("c1", "u1", "A"), ("c1", "u1", "A"), ("c1", "u2", "A")], TRIPLES)
    many = data.select("client", "link").distinct().withColumn("ufrq", F.lit(2).cast("long"))
    assert rows(prune_interactions(data, many, links_per_item(data), 10)) == [("c1", "u1", "A"), ("c1", "u2", "A")]
