"""What the executed plans of the jobs must look like, whatever the sizes."""

import os
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from cobasket import order_suggestions, purchase_suggestions
from cobasket.operators.cooccurrence import cooccurrences
from cobasket.operators.frequencies import items_per_buyer, items_per_link, links_per_item
from cobasket.operators.interactions import prune_interactions, purchase_interactions, valid_interactions
from cobasket.operators.lookup import look_up
from cobasket.plans.similar_items import purchase_edges
from cobasket.schemas import schema_of
from cobasket.sources.dumps import read_json, write_json
from cobasket.tuning import Tuning
from testbed.queries import QUERIES
from tests.helpers import as_edges, brute_force_edges, catalog, events, exchanges, rounded

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
JOBS = {"purchase": purchase_suggestions, "order": order_suggestions}
UNUSED = ("items.product.specs", "items.product.price")
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed_plan(df):
    df.collect()
    # Nodes in one-letter-per-line form; the initial plan repeats everything, so it is cut off.
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def json_inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    statuses = {f"i{n}": "AVAILABLE" for n in range(40)}
    orders = [(f"u{n % 50}", f"o{n}", [f"i{(n * k) % 40}" for k in range(1, 6)]) for n in range(300)]
    write_json(catalog(spark, statuses), str(root / "products"))
    write_json(events(spark, orders), str(root / "events"))
    return (
        read_json(spark, str(root / "products"), schema_of("catalog", "products")),
        read_json(spark, str(root / "events"), schema_of("event", "buyorder", drop=UNUSED)),
    )


@pytest.mark.parametrize("mode", sorted(JOBS))
@pytest.mark.parametrize("conf", [{}, NO_BROADCAST], ids=["broadcast", "shuffle"])
def test_job_plan(spark, json_inputs, mode, conf):
    with settings(spark, conf):
        plan = executed_plan(JOBS[mode](*json_inputs))
    # Each source is scanned once and only for the fields in use.
    scans = re.findall(r"ReadSchema: (\S+)", plan)
    assert len(scans) == plan.count("FileScan json") == 2
    assert not any(field in scan for scan in scans for field in ("price", "specs", "total", "date"))
    # Items are cut to the best K before their exchange and after it.
    assert plan.count("WindowGroupLimit") == 2
    # The rows are sorted once per exchange by buyer, and baskets need no other order.
    orders = re.findall(r"Sort \[(client#\d+ ASC NULLS FIRST, \w+#\d+ ASC NULLS FIRST, (?:link|freq)#[^]]*)", plan)
    assert len(orders) == 1
    # All in the JVM, no cross products.
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_columnar_sources_are_pruned_inside_the_items(spark, tmp_path):
    events(spark, [("u1", "o1", ["A", "B"])]).write.parquet(str(tmp_path / "p"))
    plan = executed_plan(purchase_interactions(spark.read.parquet(str(tmp_path / "p"))))
    assert "ReadSchema: struct<client:string,user_id:string,items:array<struct<product:struct<id:string>>>>" in plan


def test_jobs_leave_the_session_as_it_was(spark, json_inputs):
    before = sorted((r.key, r.value) for r in spark.sql("SET").collect())
    for job in JOBS.values():
        job(*json_inputs, Tuning(0.2, max_user_events=5000)).count()
    assert sorted((r.key, r.value) for r in spark.sql("SET").collect()) == before


@pytest.mark.parametrize("name", ["frequency_pruning", "cooccurrence", "cooccurrence_order", "user_freq_order"])
@pytest.mark.parametrize("conf", [{}, NO_BROADCAST], ids=["broadcast", "shuffle"])
def test_queries_of_single_operators_scan_each_source_once(spark, name, conf):
    if not os.path.isdir(SF_DIR):
        pytest.skip("benchmark tables are not here")
    with settings(spark, conf):
        plan = executed_plan(QUERIES[name](spark, SF_DIR))
    sources = re.findall(r"FileScan parquet .*?/(\w+)\.parquet", plan)
    assert "lineitem" in sources and len(sources) == len(set(sources))


# Skew settings for inputs of a few hundred kilobytes.
TINY_SKEW = NO_BROADCAST | {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
SPLIT = "SortMergeJoin(skew=true)"


def _hot_item_orders():
    return [(f"u{n}", f"o{n}", ["hot", f"i{n % 50}"] if n % 4 == 0 else ["hot"]) for n in range(6000)]


def test_a_popular_item_is_split_in_the_job(spark, tmp_path):
    statuses = {"hot": "AVAILABLE"} | {f"i{n}": "AVAILABLE" for n in range(50)}
    orders = _hot_item_orders()
    write_json(events(spark, orders).repartition(8), str(tmp_path / "events"))
    data = read_json(spark, str(tmp_path / "events"), schema_of("event", "buyorder"))
    with settings(spark, TINY_SKEW):
        edges = purchase_edges(catalog(spark, statuses), data, Tuning(0.2, min_amf=1, min_nmf=0))
        assert SPLIT in executed_plan(edges)
        found = as_edges(edges)
    assert found == rounded(brute_force_edges(statuses, orders, "purchase", 1000, 1, 0))


def test_a_buyer_with_most_rows_leaves_before_rows_are_gathered(spark, tmp_path):
    statuses = {f"i{n}": "AVAILABLE" for n in range(3000)}
    orders = [("guest", f"g{n}", [f"i{n % 3000}"]) for n in range(9000)]
    orders += [(f"u{n}", f"o{n}", [f"i{n % 20}", f"i{(n * 7) % 20}"]) for n in range(400)]
    write_json(events(spark, orders).repartition(8), str(tmp_path / "events"))
    data = read_json(spark, str(tmp_path / "events"), schema_of("event", "buyorder"))
    for conf in ({}, TINY_SKEW):
        with settings(spark, conf):
            edges = purchase_edges(catalog(spark, statuses), data, Tuning(0.2, min_amf=1, min_nmf=0))
            plan = executed_plan(edges)
            assert "LeftAnti" in plan and (not conf or "LeftAnti" in plan and SPLIT in plan)
            assert as_edges(edges) == rounded(brute_force_edges(statuses, orders, "purchase", 1000, 1, 0))


def test_hot_keys_are_split_in_the_single_operators(spark):
    interactions = [("c1", u, i) for u, _, items in _hot_item_orders() for i in items]
    interactions += [("c1", "guest", f"g{n}") for n in range(4000)]
    df = spark.createDataFrame(interactions, "client string, link string, item string").repartition(8)
    items = df.select("client", "item").distinct()
    orders = df.select("client", F.col("link").alias("user_id"), F.concat("link", "item").alias("link"), "item")
    with settings(spark, TINY_SKEW):
        assert SPLIT in executed_plan(valid_interactions(df, items))
        assert SPLIT in executed_plan(items_per_buyer(orders))
        links, frequencies = items_per_link(df), links_per_item(df)
        pruned = prune_interactions(df, links, frequencies, 1000)
        assert executed_plan(pruned).count(SPLIT) == 2
        assert SPLIT in executed_plan(cooccurrences(df, links, frequencies, 10, 0))


def test_a_lookup_sends_no_hash_with_each_row(spark):
    n = 50_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("k"))
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("times"))
    with settings(spark, NO_BROADCAST):
        found = look_up(rows, table, ["k"])
        assert found.count() == n
        found.collect()
        sent = [size for count, size in exchanges(found) if count == n]
    assert max(sent) < 10 * n
