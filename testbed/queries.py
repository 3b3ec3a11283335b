"""Every operator as a query over the benchmark tables, in the output shape of its oracle.

Scores are emitted as whole millionths, which both engines agree on.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cobasket.functions.scores import bound
from cobasket.operators.cooccurrence import cooccurrences, mirrored
from cobasket.operators.documents import suggestion_documents, result_arrays
from cobasket.operators.frequencies import items_per_buyer, items_per_link, links_per_item
from cobasket.operators.interactions import (
    complete,
    order_interactions,
    prune_interactions,
    purchase_interactions,
    sellable_items,
    valid_interactions,
    with_order_key,
)
from cobasket.operators.lookup import look_up
from cobasket.operators.ranking import best_per_item, normalised, ranked_similar, scored
from cobasket.plans.jobs import MODES, run_job
from cobasket.plans.similar_items import (
    order_edges,
    order_suggestions,
    order_similar_items,
    purchase_edges,
    purchase_suggestions,
    purchase_similar_items,
)
from cobasket.schemas import schema_of
from cobasket.sources.dumps import read_catalog, read_json, read_suggestions, write_json
from cobasket.sources.snapshots import latest_partition, latest_snapshot, trailing_months
from cobasket.tuning import ORDER_TUNING, PURCHASE_TUNING
from testbed.binding import nested_orders, order_lines, products, table
from testbed.folders import shared_path

PRUNING_CAP = 30
CATALOG_BITS = 1 << 20
REFERENCE_DAY = date(1998, 6, 15)
SNAPSHOT_CUTOFF = "19980615-000000"


def _micro(column: str) -> Column:
    return F.round(F.col(column) * F.lit(1e6)).cast("bigint").alias(f"{column}_u")


def _interactions(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    events = order_lines(spark, sf_dir)
    return purchase_interactions(events) if mode == "purchase" else with_order_key(order_interactions(events))


def _valid(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    return valid_interactions(_interactions(spark, sf_dir, mode), sellable_items(products(spark, sf_dir)))


def item_filter(spark, sf_dir):
    return sellable_items(products(spark, sf_dir))


def explode_purchase(spark, sf_dir):
    return purchase_interactions(nested_orders(spark, sf_dir))


def explode_order(spark, sf_dir):
    return with_order_key(order_interactions(nested_orders(spark, sf_dir)))


def valid_events(spark, sf_dir):
    return _valid(spark, sf_dir, "purchase")


def valid_events_by_bloom_filter(spark, sf_dir):
    interactions = purchase_interactions(order_lines(spark, sf_dir))
    return valid_interactions(interactions, sellable_items(products(spark, sf_dir)), catalog_bits=CATALOG_BITS)


def user_freq_purchase(spark, sf_dir):
    return items_per_link(_valid(spark, sf_dir, "purchase"))


def user_freq_order(spark, sf_dir):
    return items_per_buyer(_valid(spark, sf_dir, "order"))


def item_freq(spark, sf_dir):
    return links_per_item(_valid(spark, sf_dir, "purchase"))


def frequency_pruning(spark, sf_dir):
    rows = purchase_interactions(order_lines(spark, sf_dir, product="l_partkey"))
    rows = complete(rows, "client", "link", "item").distinct()
    link_freq, item_freq = items_per_link(rows, distinct_rows=True), links_per_item(rows, distinct_rows=True)
    return prune_interactions(rows, link_freq, item_freq, PRUNING_CAP, distinct_rows=True)


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of purchase mode, composed of the single operators, without the fused plan of the jobs."""
    rows = complete(_interactions(spark, sf_dir, "purchase"), "client", "link", "item").distinct()
    catalog = sellable_items(products(spark, sf_dir)).distinct()
    # An inner join with distinct keys keeps the scan shared, see prune_interactions.
    rows = look_up(rows, catalog, ["client", "item"]).select(*rows.columns)
    link_freq, item_freq = items_per_link(rows, distinct_rows=True), links_per_item(rows, distinct_rows=True)
    pruned = prune_interactions(rows, link_freq, item_freq, PURCHASE_TUNING.max_user_events, distinct_rows=True)
    return cooccurrences(pruned, link_freq, item_freq, PURCHASE_TUNING.min_amf, PURCHASE_TUNING.min_nmf)


def _edge_columns(edges: DataFrame) -> DataFrame:
    return edges.select("client", "item_ref", "item_rec", "amf", _micro("nmf"), "freq_ref", "freq_rec")


def cooccurrence(spark, sf_dir):
    return _edge_columns(_edges(spark, sf_dir))


def cooccurrence_order(spark, sf_dir):
    return _edge_columns(order_edges(products(spark, sf_dir), order_lines(spark, sf_dir)))


def cooccurrence_order_buckets(spark, sf_dir):
    tuning = ORDER_TUNING.with_overrides(pair_buckets=1 << 18)
    return _edge_columns(order_edges(products(spark, sf_dir), order_lines(spark, sf_dir), tuning))


def mirror(spark, sf_dir):
    return _edge_columns(mirrored(order_edges(products(spark, sf_dir), order_lines(spark, sf_dir))))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = purchase_edges(products(spark, sf_dir), order_lines(spark, sf_dir))
    return scored(mirrored(edges), PURCHASE_TUNING.alpha, PURCHASE_TUNING.adjust)


def asl_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("client", "item_ref", "item_rec", _micro("asl"))


def rank_topk(spark, sf_dir):
    ranked = best_per_item(_scored(spark, sf_dir), PURCHASE_TUNING.max_similar)
    return ranked.select("client", "item_ref", "item_rec", F.col("rank").cast("bigint"))


def nsl(spark, sf_dir):
    ranked = best_per_item(_scored(spark, sf_dir), PURCHASE_TUNING.max_similar)
    return normalised(ranked).select("client", "item_ref", "item_rec", _micro("nsl"))


def _results(arrays: DataFrame, *keys: str | Column) -> DataFrame:
    """One row per result: its keys, its place and all its members."""
    flat = arrays.select(*keys, F.posexplode("results").alias("pos", "r"))
    members = flat.select(*flat.columns[:-2], F.col("pos").cast("bigint"), "r.*")
    scores = ("nmf", "asl", "nsl")
    return members.select(*[c for c in members.columns if c not in scores], *map(_micro, scores))


def results_array(spark, sf_dir):
    arrays = result_arrays(purchase_similar_items(products(spark, sf_dir), order_lines(spark, sf_dir)))
    return _results(arrays, "client", "item_ref")


def _document_columns(documents: DataFrame) -> DataFrame:
    tuning = [F.col(f"tuning.{name}").alias(f"t_{name}") for name in ("nmf", "alpha", "adjust", "amf")]
    return _results(documents, "client", "product", *tuning)


def formatted_output(spark, sf_dir):
    tuning = PURCHASE_TUNING
    ranked = ranked_similar(mirrored(_edges(spark, sf_dir)), tuning.alpha, tuning.adjust, tuning.max_similar)
    return _document_columns(suggestion_documents(result_arrays(ranked), tuning))


def purchase_documents(spark, sf_dir):
    return _document_columns(purchase_suggestions(products(spark, sf_dir), order_lines(spark, sf_dir)))


def buyorder_documents(spark, sf_dir):
    return _document_columns(order_suggestions(products(spark, sf_dir), order_lines(spark, sf_dir)))


def _dated_catalog(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Generations of the catalog as JSON in the layout of a dated run.

    The newest one never finished, and holds nothing that is true.
    """
    catalog = products(spark, sf_dir)
    write_json(catalog.withColumn("status", F.lit("REMOVED")), f"{root}/products/19980101-000000")
    write_json(catalog, f"{root}/products/19980501-000000")
    unfinished = f"{root}/products/19980601-000000"
    spark.range(1).select(F.lit("not JSON").alias("value")).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).text(unfinished)


def _dated_inputs(spark: SparkSession, sf_dir: str) -> str:
    """Catalog and monthly orders as JSON in the layout of a dated run; the folder they are in."""
    root = shared_path(spark, "dated")
    _dated_catalog(spark, sf_dir, root)
    month = date(REFERENCE_DAY.year, REFERENCE_DAY.month - 1, 1)
    write_json(nested_orders(spark, sf_dir), f"{root}/buyorder/{month:%Y-%m-%d}")
    return root


def _dated_run(spark: SparkSession, sf_dir: str, mode: str, **options) -> DataFrame:
    """Run one mode on dated inputs and read its documents back."""
    root = _dated_inputs(spark, sf_dir)
    run_job(spark, mode, root, root, f"{root}/outputs", REFERENCE_DAY, generation=SNAPSHOT_CUTOFF, **options)
    return _document_columns(read_suggestions(spark, f"{root}/outputs", MODES[mode].algorithm))


def purchase_dated_run(spark, sf_dir):
    return _dated_run(spark, sf_dir, "purchase")


def buyorder_dated_run(spark, sf_dir):
    return _dated_run(spark, sf_dir, "buyorder")


def purchase_dated_run_by_client(spark, sf_dir):
    """The output laid out by client, of which one client's documents are read."""
    return _dated_run(spark, sf_dir, "purchase", by_client=True).filter(F.col("client") == "BUILDING")


def catalog_snapshot(spark, sf_dir):
    root = shared_path(spark, "dated")
    _dated_catalog(spark, sf_dir, root)
    return read_catalog(spark, root)


def _flat(suggestions: DataFrame) -> DataFrame:
    return suggestions.select(
        "client",
        "item_ref",
        "item_rec",
        "amf",
        _micro("nmf"),
        "freq_ref",
        "freq_rec",
        _micro("asl"),
        F.col("rank").cast("bigint"),
        _micro("nsl"),
    )


def purchase_topk(spark, sf_dir):
    return _flat(purchase_similar_items(products(spark, sf_dir), order_lines(spark, sf_dir)))


def buyorder_topk(spark, sf_dir):
    return _flat(order_similar_items(products(spark, sf_dir), order_lines(spark, sf_dir)))


def trailing_months_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return trailing_months(orders, F.col("o_orderdate"), REFERENCE_DAY, 1).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")
    )


def latest_snapshot_query(spark, sf_dir):
    month = F.trunc("o_orderdate", "month")
    orders = table(spark, sf_dir, "orders").select(
        F.date_format(month, "yyyyMMdd-HHmmss").alias("generation"), "o_orderkey"
    )
    complete = F.substring("generation", 5, 2).cast("int") % 6 != 0
    return latest_snapshot(orders, "generation", complete, SNAPSHOT_CUTOFF)


def latest_partition_query(spark, sf_dir):
    """Orders partitioned by the month they are of, as generations, of which the newest up to a cutoff is read."""
    generation = F.date_format(F.trunc("o_orderdate", "month"), "yyyyMMdd-HHmmss")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", generation.alias("generation"))
    path = shared_path(spark, "generations")
    orders.repartition("generation").write.partitionBy("generation").parquet(path)
    return latest_partition(spark.read.parquet(path), "generation", SNAPSHOT_CUTOFF)


def json_roundtrip(spark, sf_dir):
    path = shared_path(spark, "orders")
    write_json(nested_orders(spark, sf_dir), path)
    schema = schema_of("event", "buyorder", ("client", "items", "user_id"), ("items.product.specs",))
    return purchase_interactions(read_json(spark, path, schema))


def bound_query(spark, sf_dir):
    value = F.col("value")
    bounded = F.when(value >= 0, bound(value)).alias("b")  # null outside its domain
    return table(spark, sf_dir, "events").select("event_id", bounded).select("event_id", _micro("b"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "item_filter": item_filter,
    "explode_purchase": explode_purchase,
    "explode_order": explode_order,
    "valid_events": valid_events,
    "valid_events_by_bloom_filter": valid_events_by_bloom_filter,
    "user_freq_purchase": user_freq_purchase,
    "user_freq_order": user_freq_order,
    "item_freq": item_freq,
    "frequency_pruning": frequency_pruning,
    "cooccurrence": cooccurrence,
    "cooccurrence_order": cooccurrence_order,
    "cooccurrence_order_buckets": cooccurrence_order_buckets,
    "mirror": mirror,
    "asl_score": asl_score,
    "rank_topk": rank_topk,
    "nsl": nsl,
    "results_array": results_array,
    "formatted_output": formatted_output,
    "purchase_documents": purchase_documents,
    "buyorder_documents": buyorder_documents,
    "purchase_topk": purchase_topk,
    "buyorder_topk": buyorder_topk,
    "catalog_snapshot": catalog_snapshot,
    "purchase_dated_run": purchase_dated_run,
    "buyorder_dated_run": buyorder_dated_run,
    "purchase_dated_run_by_client": purchase_dated_run_by_client,
    "trailing_months": trailing_months_query,
    "latest_snapshot": latest_snapshot_query,
    "latest_partition": latest_partition_query,
    "json_roundtrip": json_roundtrip,
    "bound": bound_query,
}
