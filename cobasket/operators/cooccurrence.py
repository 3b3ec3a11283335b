"""Which items share links, how often (``amf``) and with what weight (``nmf``).

Counting pairs is the one quadratic step, so it is laid out with care:

1. *Baskets.* The items of a link are gathered once, ordered by (freq, item); each row of the link
   sees its basket and its place in it. Links longer than ``BLOCK`` are cut into blocks of items first,
   and every pair of blocks becomes its own basket, so no task holds a whole long link.
2. *Stripes.* Each item of a basket is sent with the array of items behind it, instead of one row
   per pair, items as their numbers, in halves of two bytes of which the upper one is mostly zero, and the link's ``ufrq`` in
   place of the weight, which is worked out behind the exchange. The key of a stripe is the rarer item of all its
   pairs, so popular items hardly ever act as keys; the ones that do are spread over several tasks by a hash of
   link and blocks, so that no task unrolls more than a bounded number of pairs of one item.
3. *Counting.* Stripes of one key are gathered into one row, and its pairs are sorted and counted within it, key after
   key. So a task holds its stripes and the pairs of one key, never a hash table of all its pairs, which would be
   many times the stripes and spill. Keys that were not spread are complete at once and meet the thresholds
   before anything else moves; only the survivors and the partial counts of spread keys are exchanged again.
4. *Items and frequencies* join the surviving pairs by number; they don't travel with the stripes.

Where hardly any pair reaches the threshold, ``buckets`` comes ahead of 2: pairs are first counted by a hash into so many
buckets, and only pairs of buckets that reach it are sent on, each as a stripe of its own. Buckets only count too much, so
nothing is lost.

Weights are added up as integers, so neither order nor layout can change them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cobasket.operators.lookup import look_up

# Items of a link per block; links and pairs of an item per stripe group.
BLOCK = 1024
LINKS_PER_GROUP = 100_000
PAIRS_PER_GROUP = 10_000_000

# A weight is a pair of integers: billionths, and billionths of those. Their sums are exact.
UNIT = 1_000_000_000
# Digits of the final weight, below which a double can't tell sums like three times 2/15 from 0.4.
WEIGHT_DIGITS = 12

# What is taken from 16 bits to fit a smallint.
HALF = 1 << 15

# Hash parts of a client's items, within which they are numbered.
NUMBER_PARTS = 1024


def _whole(ufrq: Column) -> Column:
    """2/ufrq in whole billionths."""
    return F.floor(F.try_divide(F.lit(2.0), ufrq) * UNIT).cast("long")


def _rest(ufrq: Column) -> Column:
    """What 2/ufrq is more than that, in billionths of a billionth."""
    norm = F.try_divide(F.lit(2.0), ufrq)
    return F.round((norm * UNIT - F.floor(norm * UNIT)) * UNIT).cast("long")


def _nmf() -> Column:
    """The weight as a double, rounded once, from the summed ``whole`` and ``rest``."""
    return F.round(F.col("whole") / F.lit(float(UNIT)) + F.col("rest") / F.lit(float(UNIT) ** 2), WEIGHT_DIGITS)


def _passes(min_amf: float, min_nmf: float) -> Column:
    return (F.col("amf") >= F.lit(float(min_amf))) & (_nmf() >= F.lit(float(min_nmf)))


def numbered_items(item_freq: DataFrame) -> DataFrame:
    """``(client, item, freq)`` with a ``number``, an integer of its own for each item of a client.

    Items are numbered in hash parts, so no task holds a whole client, and by their order, so numbers are the same
    whenever they are computed anew.
    """
    part = F.xxhash64("item").bitwiseAND(F.lit(NUMBER_PARTS - 1)).alias("part")
    in_order = F.sort_array(F.collect_list(F.struct("item", "freq")))
    placed = item_freq.groupBy("client", part).agg(in_order.alias("items")).select("client", "part", F.posexplode("items").alias("place", "own"))
    number = F.col("place").cast("long") * NUMBER_PARTS + F.col("part")
    return placed.select("client", "own.item", "own.freq", number.cast("int").alias("number"))


def _long_links(rows: DataFrame, keys: list[str], block: int) -> DataFrame:
    """The links of more than one block with their ``length``, counted map-side, so no task gathers a link before it is cut."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("length")).filter(F.col("length") > block)


def _split_long_links(rows: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Copy the rows of long links into one group per pair of item blocks ``(lo, hi)``.

    Rows may come with the ``length`` of their link, null for one block; else it is looked up.
    """
    if "length" not in rows.columns:
        rows = look_up(rows, _long_links(rows, keys, block), keys, "left")
    n_blocks = F.coalesce(F.ceil(F.col("length") / F.lit(float(block))), F.lit(1).cast("long"))
    rows = rows.withColumn("n_blocks", n_blocks).drop("length")
    own = F.pmod(F.xxhash64("item"), F.col("n_blocks"))
    rows = rows.select(
        "*", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("other")
    )
    return rows.select("*", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))


def _may_be_long(longest_link: int | None = None, block: int = BLOCK, **_) -> bool:
    return longest_link is None or longest_link > block


def count_pairs(
    rows: DataFrame,
    item_freq: DataFrame,
    min_amf: float,
    min_nmf: float,
    link_keys: tuple[str, ...] = ("client", "link"),
    longest_link: int | None = None,
    block: int = BLOCK,
    links_per_group: int = LINKS_PER_GROUP,
    pairs_per_group: int = PAIRS_PER_GROUP,
    buckets: int = 0,
) -> DataFrame:
    """Count the item pairs of ``(client, link, item, freq, ufrq)`` rows and apply the thresholds.

    ``item_freq`` has the (client, item, freq) that surviving pairs are given. Where the caller has numbered it (see
    :func:`numbered_items`), rows may come with a ``number`` in place of the item; else it is looked up. ``link_keys`` may name a
    coarser partitioning that the rows already have (the buyer of an order). ``longest_link`` is a
    known bound of the items of a link; up to ``block`` the splitting of long links is left out of the plan. Rows with a ``length``
    are taken to be of a link of at least so many rows, or of no more than ``block`` where it is null. ``buckets``, if any, is the
    number of hash buckets in which pairs are counted first; a table of at most so many numbers is broadcast.
    """
    if "number" not in item_freq.columns:
        item_freq = numbered_items(item_freq)
    if "number" not in rows.columns:
        rows = look_up(rows, item_freq.select("client", "item", "number"), ["client", "item"])
    # From here on an item is its number.
    rows = rows.drop("item").withColumnRenamed("number", "item")
    keys = list(link_keys)
    member = [F.col("item")]
    split = _may_be_long(longest_link, block)
    if split:
        rows = _split_long_links(rows, keys, block)
        keys += ["lo", "hi"]
        # The window alone would keep all blocks of a link together in the partitioning of the input.
        rows = rows.repartition(*keys)
        member = [F.struct("item", "own")]

    in_order = Window.partitionBy(*keys).orderBy("freq", "item")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    baskets = rows.select(
        "*",
        F.collect_list(*member).over(whole).alias("basket"),
        F.row_number().over(in_order).alias("pos"),
    ).filter(F.col("pos") < F.size("basket"))
    behind = F.slice("basket", F.col("pos") + 1, F.size("basket"))
    if split:
        # Two items of one block meet in the basket of that block alone, not in the mixed ones.
        others = F.filter(behind, lambda b: b["own"] != F.col("own"))
        behind = F.when(F.col("lo") == F.col("hi"), behind).otherwise(others)["item"]

    # A link of many blocks gives an item as many stripes, each with the items of two blocks at most.
    stripes_per_link = -(-longest_link // block) if split and longest_link else 1
    longest_stripe = 2 * block if split else longest_link
    load = F.col("freq") * F.lit(float(stripes_per_link))
    fine = F.greatest(load / F.lit(float(links_per_group)), load * F.lit(float(longest_stripe)) / F.lit(float(pairs_per_group)))
    groups = F.greatest(F.ceil(fine), F.lit(1).cast("long"))
    part = F.pmod(F.xxhash64("link", *(("lo", "hi") if split else ())), groups)
    stripes = baskets.select(
        "client",
        F.col("item").alias("a"),
        part.alias("part"),
        (groups > 1).alias("spread"),
        "ufrq",
        behind.alias("behind"),
    )
    if buckets:
        stripes = _in_full_buckets(stripes, buckets, min_amf)
    stripes = stripes.select("client", "a", "part", "spread", "ufrq", *_halves("behind")).repartition("client", "a", "part")
    return _with_frequencies(_count_stripes(stripes, math.ceil(min_amf), _passes(min_amf, min_nmf)), item_freq)


def _halves(numbers: str) -> list[Column]:
    """Numbers as an array of their lower and one of their upper 16 bits, which are mostly zero and compress to next to nothing."""
    lower = F.transform(numbers, lambda n: (n.bitwiseAND(0xFFFF) - HALF).cast("smallint"))
    return [lower.alias("lower"), F.transform(numbers, lambda n: F.shiftright(n, 16).cast("smallint")).alias("upper")]


def _in_full_buckets(stripes: DataFrame, buckets: int, min_amf: float) -> DataFrame:
    """Stripes of one pair each, of the pairs whose hash bucket holds enough pairs for one of them to reach ``min_amf``."""
    pairs = stripes.withColumn("b", F.explode("behind")).drop("behind").filter(F.col("a") != F.col("b"))
    pairs = pairs.withColumn("bucket", F.pmod(F.xxhash64("client", "a", "b"), F.lit(buckets)))
    full = pairs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= F.lit(float(min_amf)))
    # At most ``buckets`` numbers.
    kept = pairs.join(F.broadcast(full.select("bucket")), "bucket", "left_semi")
    return kept.withColumn("behind", F.array("b")).drop("b", "bucket")


def _count_stripes(stripes: DataFrame, least: int, passes: Column) -> DataFrame:
    """Count the pairs of each key within one row, and those of spread keys once more over all their parts.

    ``least`` is the smallest ``amf`` that may pass.
    """
    keys = ["client", "a", "part", "spread"]
    gathered = stripes.groupBy(*keys).agg(F.collect_list(F.struct("lower", "upper", "ufrq")).alias("stripes"))

    def pair(lower: Column, upper: Column, place: Column) -> Column:
        return F.shiftleft(upper.cast("long") * (2 * HALF) + (lower + F.lit(HALF)), 32).bitwiseOR(place.cast("long"))

    # A pair is one long, the number of the other item above the place of its stripe. Sorted, those of one item are a run.
    places = F.transform("stripes", lambda s, place: F.zip_with(s["lower"], s["upper"], lambda lower, upper: pair(lower, upper, place)))
    weights = [F.transform("stripes.ufrq", weight).alias(name) for name, weight in (("whole", _whole), ("rest", _rest))]
    ordered = gathered.select(*keys, *weights, F.sort_array(F.flatten(places)).alias("pairs"))

    def other(at: Column) -> Column:
        return F.shiftrightunsigned(F.get("pairs", at), 32).cast("int")

    size = F.size("pairs")
    # The end of a run is the start of the next one. None of these is merged into the next step: each is used there repeatedly.
    ends = F.filter(F.sequence(F.lit(0), size), lambda i: (i > 0) & ((i == size) | (other(i) != other(i - 1))))
    bounded = ordered.withColumn("ends", ends)
    runs = F.transform("ends", lambda end, n: F.struct(F.coalesce(F.get("ends", n - 1), F.lit(0)).alias("start"), end.alias("end")))
    enough = F.filter(runs, lambda r: (F.col("spread") | (r["end"] - r["start"] >= least)) & (other(r["start"]) != F.col("a")))

    def total(weights: str, run: Column) -> Column:
        """The sum over a run, as ``F.sum`` has it: null weights don't count, and without others it is null."""
        own = F.slice("pairs", run["start"] + 1, run["end"] - run["start"])

        def add(sum_: Column, pair: Column) -> Column:
            weight = F.get(weights, pair.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("int"))
            return F.coalesce(sum_ + weight, sum_, weight)

        return F.aggregate(own, F.lit(None).cast("long"), add)

    counts = F.transform(
        enough,
        lambda r: F.struct(
            other(r["start"]).alias("b"),
            (r["end"] - r["start"]).cast("long").alias("amf"),
            *[total(w, r).alias(w) for w in ("whole", "rest")],
        ),
    )
    # The outer form: for the inner one the optimizer would compute the counts once more to leave empty rows out.
    counted = bounded.select(*keys, counts.alias("counts")).select(*keys, F.inline_outer("counts"))
    counted = counted.filter(F.col("b").isNotNull() & (F.col("spread") | passes))
    # An item rarer in one link is so in all, so a pair has one key, and all its parts meet here.
    sums = [F.sum(c).alias(c) for c in ("amf", "whole", "rest")]
    return counted.groupBy("client", "a", "b").agg(*sums).filter(passes)


def _with_frequencies(edges: DataFrame, items: DataFrame) -> DataFrame:
    """Look up the items of both numbers of each edge and how often they occur, and order the ends."""
    pairs = edges.select("client", "a", "b", "amf", _nmf().alias("nmf"))
    for end in ("a", "b"):
        known = items.select("client", F.col("number").alias(end), F.col("item").alias(f"item_{end}"), F.col("freq").alias(f"freq_{end}"))
        pairs = look_up(pairs, known, ["client", end])
    in_order = F.col("item_a") < F.col("item_b")
    return pairs.select(
        "client",
        F.least("item_a", "item_b").alias("item_ref"),
        F.greatest("item_a", "item_b").alias("item_rec"),
        "amf",
        "nmf",
        F.when(in_order, F.col("freq_a")).otherwise(F.col("freq_b")).alias("freq_ref"),
        F.when(in_order, F.col("freq_b")).otherwise(F.col("freq_a")).alias("freq_rec"),
    )


def cooccurrences(
    interactions: DataFrame,
    link_freq: DataFrame,
    item_freq: DataFrame,
    min_amf: float,
    min_nmf: float,
    **layout,
) -> DataFrame:
    """Pairs of items that share links, each once with ``item_ref < item_rec``.

    ``amf`` counts the shared links, ``nmf`` adds 2/ufrq over them; pairs below either threshold are
    dropped. The frequencies are those given and appear on both sides of the pair. ``layout`` goes
    to :func:`count_pairs`.
    """
    items = numbered_items(item_freq)
    rows = look_up(interactions.select("client", "link", "item"), items, ["client", "item"])
    links = link_freq.select("client", "link", "ufrq")
    if _may_be_long(**layout) and "link_keys" not in layout:
        # Links meet their lengths, one row per link, so that one exchange brings both to the rows.
        links = look_up(links, _long_links(interactions, ["client", "link"], layout.get("block", BLOCK)), ["client", "link"], "left")
    rows = look_up(rows, links, ["client", "link"])
    return count_pairs(rows, items, min_amf, min_nmf, **layout)


def mirrored(edges: DataFrame) -> DataFrame:
    """Each edge in both directions, in one pass over the input."""
    forward = F.struct("item_ref", "item_rec", "freq_ref", "freq_rec")
    backward = F.struct(
        F.col("item_rec").alias("item_ref"),
        F.col("item_ref").alias("item_rec"),
        F.col("freq_rec").alias("freq_ref"),
        F.col("freq_ref").alias("freq_rec"),
    )
    return edges.select("client", "amf", "nmf", F.inline(F.array(forward, backward))).select(
        "client", "item_ref", "item_rec", "amf", "nmf", "freq_ref", "freq_rec"
    )
