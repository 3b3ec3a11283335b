import random
from collections import defaultdict
from fractions import Fraction
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cobasket.operators.cooccurrence import _split_long_links, cooccurrences, count_pairs, mirrored, numbered_items
from cobasket.operators.frequencies import items_per_link, links_per_item
from cobasket.operators.ranking import ranked_similar
from tests.helpers import EDGE_TYPES, as_edges, exchanges, executed_nodes, rounded, rows

TRIPLES = "client string, link string, item string"
LAYOUTS = [
    {},
    {"longest_link": 60},
    {"block": 4},
    {"block": 1},
    {"block": 7, "links_per_group": 3},
    {"longest_link": 60, "links_per_group": 1},
    {"longest_link": 60, "pairs_per_group": 100},
    {"block": 7, "buckets": 1},
    {"longest_link": 60, "buckets": 64},
    {"buckets": 1 << 18},
]


def _random_interactions(seed, n_links=40, n_items=25, longest=22):
    rng = random.Random(seed)
    data = set()
    for n in range(n_links):
        for item in rng.sample(range(n_items), rng.randint(1, longest)):
            data.add((rng.choice(["c1", "c1", "c2"]) if n % 5 == 0 else "c1", f"u{n}", f"i{item}"))
    return sorted(data)


def _expected(data, min_amf, min_nmf):
    baskets, freq = defaultdict(set), defaultdict(int)
    for client, link, item in data:
        baskets[client, link].add(item)
        freq[client, item] += 1
    amf, nmf = defaultdict(int), defaultdict(float)
    for (client, _), items in baskets.items():
        for pair in combinations(sorted(items), 2):
            amf[client, *pair] += 1
            nmf[client, *pair] += 2 / len(items)
    return {
        k: (n, nmf[k], freq[k[0], k[1]], freq[k[0], k[2]])
        for k, n in amf.items()
        if n >= min_amf and round(nmf[k], 12) >= min_nmf
    }


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
@pytest.mark.parametrize("thresholds", [(0, 0), (2.1, 0.4)], ids=str)
def test_counts_match_brute_force_in_every_layout(spark, layout, thresholds):
    data = _random_interactions(1)
    df = spark.createDataFrame(data, TRIPLES)
    edges = cooccurrences(df, items_per_link(df), links_per_item(df), *thresholds, **layout)
    expected = rounded(_expected(data, *thresholds))
    assert expected and as_edges(edges) == expected


def test_repeated_rows_count_as_often_as_they_meet_and_never_with_themselves(spark):
    df = spark.createDataFrame([("c1", "u1", "A"), ("c1", "u1", "A"), ("c1", "u1", "B")], TRIPLES)
    for layout in LAYOUTS:
        edges = cooccurrences(df, items_per_link(df), links_per_item(df), 0, 0, **layout)
        assert as_edges(edges) == {("c1", "A", "B"): (2, 2.0, 1, 1)}


def test_amf_threshold_compares_as_double(spark):
    data = [("c1", f"u{n}", item) for n in range(3) for item in ("A", "B")]
    data += [("c1", f"v{n}", item) for n in range(2) for item in ("A", "C")]
    df = spark.createDataFrame(data, TRIPLES)
    edges = cooccurrences(df, items_per_link(df), links_per_item(df), 2.1, 0.4)
    assert rows(edges, "item_ref", "item_rec") == [("A", "B")]


def test_nmf_on_the_threshold_is_kept(spark):
    # 2/15 three times is 0.4, just below it in some orders of addition.
    data = [("c1", f"u{n}", f"i{i:02d}") for n in range(3) for i in range(15)]
    df = spark.createDataFrame(data, TRIPLES)
    assert cooccurrences(df, items_per_link(df), links_per_item(df), 2.1, 0.4).count() == 105


def test_ids_order_by_bytes(spark):
    data = [("c1", "u1", i) for i in ("9", "10", "2", "z", "é")]
    df = spark.createDataFrame(data, TRIPLES)
    found = rows(cooccurrences(df, items_per_link(df), links_per_item(df), 0, 0), "item_ref", "item_rec")
    assert sorted(found) == list(combinations(["10", "2", "9", "z", "é"], 2))


def test_interactions_without_a_frequency_take_no_part(spark):
    df = spark.createDataFrame([("c1", "u1", i) for i in "ABC"] + [("c1", "u2", i) for i in "AB"], TRIPLES)
    links = items_per_link(df).filter(F.col("link") != "u2")
    items = links_per_item(df).filter(F.col("item") != "C")
    assert as_edges(cooccurrences(df, links, items, 0, 0)) == {("c1", "A", "B"): (1, round(2 / 3, 9), 2, 2)}


def test_frequencies_are_those_given(spark):
    df = spark.createDataFrame([("c1", "u1", "A"), ("c1", "u1", "B")], TRIPLES)
    links = spark.createDataFrame([("c1", "u1", 8)], "client string, link string, ufrq long")
    items = spark.createDataFrame([("c1", "A", 70), ("c1", "B", 3)], "client string, item string, freq long")
    assert as_edges(cooccurrences(df, links, items, 0, 0)) == {("c1", "A", "B"): (1, 0.25, 70, 3)}


def test_result_does_not_depend_on_partitioning_or_order(spark):
    df = spark.createDataFrame(_random_interactions(2), TRIPLES)
    links, items = items_per_link(df), links_per_item(df)
    runs = [
        rows(cooccurrences(shuffled, links, items, 2.1, 0.4))
        for shuffled in (df.coalesce(1), df.repartition(7), df.orderBy(F.desc("item")))
    ]
    assert runs[0] and runs[0] == runs[1] == runs[2]


def test_a_hot_item_and_a_long_link_are_spread(spark):
    """The rarer item of a pair is the key, hot keys are split by link and long links by block."""
    data = [("c1", f"u{n}", "hot") for n in range(300)] + [("c1", f"u{n}", "warm") for n in range(300)]
    data += [("c1", "u0", f"i{n}") for n in range(200)]
    df = spark.createDataFrame(data, TRIPLES)
    edges = cooccurrences(df, items_per_link(df), links_per_item(df), 0, 0, block=16, links_per_group=10)
    assert as_edges(edges) == rounded(_expected(data, 0, 0))


def test_count_pairs_groups_by_given_keys(spark):
    data = spark.createDataFrame(
        [("c1", "u1", "k1", "A", 2, 3), ("c1", "u1", "k1", "B", 2, 3), ("c1", "u1", "k2", "A", 2, 3)],
        "client string, user_id string, link string, item string, freq long, ufrq long",
    )
    items = spark.createDataFrame([("c1", "A", 2), ("c1", "B", 2)], "client string, item string, freq long")
    edges = count_pairs(data, items, 0, 0, link_keys=("client", "user_id", "link"), longest_link=10)
    assert as_edges(edges) == {("c1", "A", "B"): (1, round(2 / 3, 9), 2, 2)}


def test_large_sums_do_not_depend_on_order_or_layout(spark):
    """Three pairs that are equal in every link stay equal to the last digit, however they are added up."""
    n = F.col("id")
    links = spark.range(200_000).select(
        F.lit("c1").alias("client"), n.cast("string").alias("link"), (3 + n % 997).alias("ufrq")
    )
    data = links.select("client", "link", F.explode(F.array(*map(F.lit, "ABC"))).alias("item"))
    freq = spark.createDataFrame([("c1", i, 200_000) for i in "ABC"], "client string, item string, freq long")
    found = set()
    for layout in ({}, {"links_per_group": 5_000}, {"links_per_group": 777, "block": 2}):
        for shuffled in (data.repartition(3, "link"), data.repartition(11).sortWithinPartitions(F.desc("link"))):
            found |= {(r.item_ref, r.item_rec, r.amf, r.nmf) for r in cooccurrences(shuffled, links, freq, 2.1, 0.4, **layout).collect()}
    assert len(found) == 3 and len({nmf for _, _, _, nmf in found}) == 1
    exact = sum(Fraction(2, 3 + i % 997) for i in range(200_000))
    assert abs(Fraction(found.pop()[3]) - exact) < Fraction(1, 10**9)
    edges = cooccurrences(data, links, freq, 2.1, 0.4)
    best = ranked_similar(mirrored(edges), 0.2, 2.0, 1).select("item_ref", "item_rec").collect()
    assert sorted(map(tuple, best)) == [("A", "C"), ("B", "C"), ("C", "B")]


def test_rows_are_copied_by_the_length_of_their_own_link(spark):
    """A buyer with many short orders has short links; a raised cap must not copy their rows."""
    data = spark.createDataFrame(
        [("c1", f"o{n // 5}", f"i{n % 5}", 500, 2500) for n in range(2500)],
        "client string, link string, item string, freq long, ufrq long",
    )
    split = _split_long_links(data, ["client", "link"], 16)
    assert split.count() == 2500
    long = data.withColumn("link", F.lit("one")).limit(64)
    assert _split_long_links(long, ["client", "link"], 16).count() == 64 * 4


def test_an_item_of_long_baskets_is_spread_by_its_pairs(spark):
    """50,000 links are few, but not in baskets of 1,000 items."""
    data = spark.range(50_000).selectExpr(
        "'c1' AS client", "cast(id AS string) AS link", "explode(array('rare', 'often')) AS item", "if(item = 'rare', 50000L, 60000L) AS freq", "2L AS ufrq"
    )
    items = spark.createDataFrame([("c1", "rare", 50_000), ("c1", "often", 60_000)], "client string, item string, freq long")
    edges = count_pairs(data, items, 0, 0, longest_link=1000)
    assert as_edges(edges) == {("c1", "often", "rare"): (50_000, 50_000.0, 60_000, 50_000)}
    few, many = (_parts(spark, data, items, longest_link=n) for n in (100, 1000))
    assert few == 1 and many == 5


def _parts(spark, data, items, **layout):
    """Distinct parts that the stripes of the rarer item go to, seen in the plan's input of the last count."""
    seen = []
    original = type(data).repartition

    def noted(self, *columns):
        if "part" in columns:
            seen.append(self.select("part").distinct().count())
        return original(self, *columns)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(data), "repartition", noted)
        count_pairs(data, items, 0, 0, **layout)
    return seen[0]


def test_no_window_gathers_a_link_before_it_is_cut(spark):
    df = spark.createDataFrame(_random_interactions(3), TRIPLES)
    edges = cooccurrences(df, items_per_link(df), links_per_item(df), 0, 0, block=4)
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate explode(sequence", 1)
    assert "Window" in above and "Window" not in below


def test_buckets_keep_rare_pairs_out_of_the_exchange(spark):
    rng = random.Random(9)
    data = [("c1", f"u{n}", f"i{i}") for n in range(400) for i in rng.sample(range(3000), 8)]
    data += [("c1", f"u{n}", item) for n in range(5) for item in ("A", "B")]
    df = spark.createDataFrame(sorted(set(data)), TRIPLES).cache()
    given = df, items_per_link(df), links_per_item(df), 2.1, 0
    expected = rounded(_expected(sorted(set(data)), 2.1, 0))
    assert ("c1", "A", "B") in expected
    for buckets in (0, 16, 1 << 16):
        edges = cooccurrences(*given, buckets=buckets)
        assert as_edges(edges) == expected
        plan = edges._jdf.queryExecution().optimizedPlan().toString()
        assert ("LeftSemi" in plan) == bool(buckets) and ("RepartitionByExpression [client#" in plan or buckets)


@pytest.mark.parametrize("longest", [40, None], ids=["whole", "split"])
def test_no_step_has_a_row_per_pair(spark, longest):
    """Hash tables of all pairs of a task outgrow its memory; stripes are counted key by key."""
    rng = random.Random(4)
    data = sorted(("c1", f"u{n}", f"i{i:02d}") for n in range(200) for i in rng.sample(range(60), 40))
    df = spark.createDataFrame(data, TRIPLES)
    edges = cooccurrences(df, items_per_link(df), links_per_item(df), 2.1, 0, longest_link=longest)
    assert as_edges(edges) == rounded(_expected(data, 2.1, 0))
    edges.collect()
    made = []
    for node in executed_nodes(edges):
        metric = node.metrics().get("numOutputRows")
        made += [metric.get().value()] if metric.isDefined() else []
    assert made and max(made) <= len(data) < 200 * 40 * 39 // 2


def test_one_exchange_brings_both_totals_and_lengths_to_the_rows(spark):
    """Of exchanges of all rows there are three: by item, by link, and into baskets."""
    rng = random.Random(6)
    data = sorted(("c1", f"u{n}", f"i{i}") for n in range(60) for i in rng.sample(range(90), 50))
    df = spark.createDataFrame(data, TRIPLES)
    links, items = (spark.createDataFrame(x.collect(), x.schema) for x in (items_per_link(df), links_per_item(df)))
    none = {key: spark.conf.get(key, None) for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for key in none:
            spark.conf.set(key, "-1")
        edges = cooccurrences(df, links, items, 2.1, 0.4)
        assert as_edges(edges) == rounded(_expected(data, 2.1, 0.4))
        edges.collect()
        assert sum(n == len(data) for n, _ in exchanges(edges)) == 3
    finally:
        for key, value in none.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_stripes_take_little_more_than_two_bytes_a_pair(spark):
    """Numbers below 65,536 have an empty upper half; as four bytes each they took more than three."""
    rng = random.Random(8)
    data = [("c1", f"u{n}", i, 2 + i * 7919 % 1000, 3) for n in range(200) for i in sorted(rng.sample(range(60_000), 100))]
    data += [("c1", f"v{n}", i, 2, 3) for n in range(3) for i in (60_000, 60_001)]
    df = spark.createDataFrame(data, "client string, link string, number int, freq long, ufrq long")
    items = spark.range(60_002).selectExpr("'c1' AS client", "cast(id AS string) AS item", "2L AS freq", "cast(id AS int) AS number")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        # As on a cluster, few stripes of one link go to the same task, where they would be compressed to what they share.
        spark.conf.set("spark.sql.shuffle.partitions", "400")
        edges = count_pairs(df.coalesce(1), items, 2.1, 0, longest_link=100)
        assert rows(edges, "item_ref", "item_rec", "amf") == [("60000", "60001", 3)]
        edges.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    pairs = 200 * 100 * 99 // 2
    written = max(size for n, size in exchanges(edges) if n == 200 * 99 + 3)
    assert written < 3.2 * pairs, written / pairs


@pytest.mark.parametrize("layout", [{"longest_link": 9}, {"block": 2}, {"buckets": 8}, {"links_per_group": 1}], ids=str)
def test_numbers_of_any_size_are_told_apart(spark, layout):
    numbers = [0, 1, 32_767, 32_768, 65_535, 65_536, 98_304, (1 << 31) - 1]
    names = {number: f"i{number}" for number in numbers}
    df = spark.createDataFrame([("c1", "u", n, 1, 8) for n in numbers], "client string, link string, number int, freq long, ufrq long")
    items = spark.createDataFrame([("c1", name, 1, n) for n, name in names.items()], "client string, item string, freq long, number int")
    found = as_edges(count_pairs(df, items, 0, 0, **layout))
    assert found == {("c1", *sorted(pair)): (1, 0.25, 1, 1) for pair in combinations(names.values(), 2)}


def test_weights_add_up_as_sums_do(spark):
    """Links without a weight count for amf alone; a pair of such links only has no nmf and passes no threshold."""
    data = [("c1", "u1", i, 3, u) for i, u in (("A", None), ("B", None), ("C", None))]
    data += [("c1", "u2", i, 3, 4) for i in "AB"]
    df = spark.createDataFrame(data, "client string, link string, item string, freq long, ufrq long")
    items = spark.createDataFrame([("c1", i, 3) for i in "ABC"], "client string, item string, freq long")
    for layout in ({"longest_link": 9}, {"longest_link": 9, "links_per_group": 1}, {"buckets": 8}):
        assert as_edges(count_pairs(df, items, 0, 0, **layout)) == {("c1", "A", "B"): (2, 0.5, 3, 3)}


def test_numbers_are_unique_and_do_not_depend_on_layout(spark):
    items = spark.range(5000).selectExpr("concat('c', id % 2) AS client", "cast(id DIV 2 AS string) AS item", "id AS freq")
    once, again = (rows(numbered_items(x)) for x in (items, items.repartition(5, "freq")))
    assert once == again and len({(c, n) for c, _, _, n in once}) == len(once) == 5000


def test_mirror_swaps_roles_and_frequencies(spark):
    edges = spark.createDataFrame([("c1", "A", "B", 3, 1.5, 4, 5)], EDGE_TYPES)
    assert rows(mirrored(edges)) == [("c1", "A", "B", 3, 1.5, 4, 5), ("c1", "B", "A", 3, 1.5, 5, 4)]
    assert mirrored(edges).columns == edges.columns
