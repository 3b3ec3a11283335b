import pytest
from pyspark.sql import functions as F

from cobasket import Tuning, purchase_similar_items
from cobasket.operators.interactions import sellable_items, valid_interactions
from cobasket.operators.membership import bit_array, possibly_in
from tests.helpers import catalog, events, executed_nodes, rows
from tests.test_plans import NO_BROADCAST, executed_plan, settings


def _rows(spark, n):
    return spark.range(n).select(F.lit("c1").alias("client"), F.col("id").cast("string").alias("item"))


@pytest.mark.parametrize("bits", [64, 1024, 1 << 14])
def test_no_row_of_the_table_is_lost(spark, bits):
    table = _rows(spark, 300).unionByName(spark.createDataFrame([("c1", None), (None, "x")], "client string, item string"))
    probe = _rows(spark, 5000).unionByName(table.filter("client is null or item is null"))
    kept = set(rows(possibly_in(probe, table, ["client", "item"], bits)))
    assert set(rows(table)) <= kept <= set(rows(probe))


def test_few_others_pass(spark):
    kept = possibly_in(_rows(spark, 20_000), _rows(spark, 1000), ["client", "item"], 1 << 14).count()
    assert 1000 <= kept < 1000 + 0.01 * 19_000  # 16 bits per key


def test_array_equals_bits_set_one_by_one(spark):
    table = _rows(spark, 40)
    (words,) = bit_array(table, ["client", "item"], 256).first()
    assert len(words) == 4
    expected = [0] * 256
    for seed in (17, 18, 19):
        for r in table.select(F.pmod(F.xxhash64("client", "item", F.lit(seed)), F.lit(256)).alias("p")).collect():
            expected[r["p"]] = 1
    assert [(words[i // 64] >> (i % 64)) & 1 for i in range(256)] == expected


def test_empty_tables_and_wrong_sizes(spark):
    assert possibly_in(_rows(spark, 9), _rows(spark, 0), ["client", "item"], 128).count() == 0
    assert possibly_in(_rows(spark, 0), _rows(spark, 9), ["client", "item"], 128).count() == 0
    for bits in (0, -64, 100):
        with pytest.raises(ValueError, match="multiple of 64"):
            bit_array(_rows(spark, 1), ["item"], bits)


def test_rows_leave_before_the_first_exchange(spark):
    interactions = _rows(spark, 10_000).withColumn("link", F.col("item") % 7).select("client", "link", "item")
    items = _rows(spark, 500)
    with settings(spark, NO_BROADCAST):
        plain, filtered = valid_interactions(interactions, items), valid_interactions(interactions, items, catalog_bits=1 << 13)
        assert rows(plain) == rows(filtered) and filtered.count() == 500
        plan = executed_plan(filtered)
    main = plan.split("Subquery")[0]
    assert "subquery" in plan.lower() and "Python" not in plan and "BroadcastHashJoin" not in main
    assert _moved(spark, filtered) < 0.2 * _moved(spark, plain)


def _moved(spark, df):
    """Rows written by the exchange of all columns, ahead of the distinct."""
    with settings(spark, NO_BROADCAST):
        df.collect()
        exchanges = [n for n in executed_nodes(df) if n.nodeName() == "Exchange"]
    return max(n.metrics().apply("shuffleRecordsWritten").value() for n in exchanges)


@pytest.mark.parametrize("conf", [{}, NO_BROADCAST], ids=["broadcast", "shuffle"])
def test_jobs_give_the_same_with_the_filter(spark, conf):
    products = catalog(spark, {f"i{n}": "AVAILABLE" for n in range(10)})
    orders = events(spark, [(f"u{n % 20}", f"o{n}", [f"i{(n * k) % 40}" for k in range(1, 6)]) for n in range(200)])
    with settings(spark, conf):
        plain = rows(purchase_similar_items(products, orders, Tuning(0.2)))
        assert plain and plain == rows(purchase_similar_items(products, orders, Tuning(0.2, catalog_bits=1 << 10)))
        plan = executed_plan(purchase_similar_items(products, orders, Tuning(0.2, catalog_bits=1 << 10)))
    assert "Python" not in plan
    assert sellable_items(products).count() == 10
