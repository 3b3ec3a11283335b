"""Shards of near equal bytes by a k-d tree over metadata, in DataFrame functions only.

Level by level, all nodes that still hold several leaves are split at once: along the dimension in which a
node is widest, at the weighted quantile that gives its left child the share of its leaves. Quantiles are
exact. They are found by histograms of every node's keys, each narrowing the interval that holds the
quantile, so that the driver sees some hundred counters per node and no task a whole node. Dimensions
are integer keys: the value's place in its range over the whole table, above bits of a hash of the row's key;
rows of equal metadata, such as copies, can therefore be cut apart.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from cobasket.llm.numbering import numbered
from cobasket.llm.storage import written
from cobasket.operators.lookup import look_up

# Dimension keys: 30 bits of value, for names with some of their hash, above 31 bits of the key's hash. Bins per histogram.
VALUE_BITS, NAME_BITS, TIE_BITS, BINS = 30, 8, 31, 256


@dataclass
class Node:
    """A box of the tree with ``leaves`` shards from ``first`` on; split once ``dim`` is set."""

    first: int
    leaves: int
    dim: int = -1
    border: int = 0  # keys up to it go left
    children: list[Node] = field(default_factory=list)
    low: int = 0  # while searching: the border lies in [low, high], ``below`` bytes lie under low
    high: int = 0
    below: int = 0
    wanted: int = 0
    at: int = 0  # bytes of the keys in [low, high]


def _spread(value: Column, low: float | None, high: float | None, bits: int) -> Column:
    """``value`` as an integer of ``bits`` bits, by its place between ``low`` and ``high``; null is lowest."""
    if low is None or low == high:
        return F.lit(0).cast("long")
    share = (value - F.lit(low)) / F.lit(high - low)
    return F.coalesce(F.floor(F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0)) * ((1 << bits) - 1)).cast("long"), F.lit(0).cast("long"))


def metadata_points(rows: DataFrame, key: str, text: str, lang: str, source: str) -> tuple[DataFrame, list[str]]:
    """A table of ``key``, ``size``, ``text_crc32`` and one key column per dimension; and the names of these.

    The dimensions are length (logarithm of the code points), language and source (logarithm of the bytes of all
    rows that have the same, names of equal bytes by a hash) and the key as a number. Each is spread over its own range in
    the whole table, so widths compare. Below the value stand bits of the key's hash. Null metadata are
    lowest, as are keys that are no numbers.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    raw = written(
        rows.select(
            F.col(key).alias("key"),
            (F.octet_length(content) + 8).cast("long").alias("size"),
            F.crc32(content.cast("binary")).alias("text_crc32"),
            F.log2(1.0 + F.char_length(content)).alias("chars"),
            F.col(lang).alias("lang"),
            F.col(source).alias("source"),
        ),
        "metadata",
    )
    number = F.col("key").cast("string").try_cast("double")
    ends = [f(c) for c in (F.col("chars"), number) for f in (F.min, F.max)]
    least_chars, most_chars, least_key, most_key = raw.agg(*ends).first()
    values = {"chars": _spread(F.col("chars"), least_chars, most_chars, VALUE_BITS)}
    points = raw
    for name in ("lang", "source"):
        # One row per value; written, so that Spark knows whether it is small enough to broadcast.
        share = F.log2(F.sum("size").cast("double")).alias(f"{name}_bytes")
        known = written(raw.where(F.col(name).isNotNull()).groupBy(name).agg(share), f"{name}_bytes")
        least, most = known.agg(F.min(f"{name}_bytes"), F.max(f"{name}_bytes")).first()
        points = look_up(points, known, [name], "left")
        alike = F.shiftrightunsigned(F.xxhash64(name, F.lit(1)), 64 - NAME_BITS)
        values[name] = F.shiftleft(_spread(F.col(f"{name}_bytes"), least, most, VALUE_BITS - NAME_BITS), NAME_BITS).bitwiseOR(alike)
    values["number"] = _spread(number, least_key, most_key, VALUE_BITS)
    tie = F.shiftrightunsigned(F.xxhash64(F.col("key").cast("string"), F.lit(31)), 64 - TIE_BITS)
    columns = {f"k{i}": F.shiftleft(v, TIE_BITS).bitwiseOR(tie) for i, v in enumerate(values.values())}
    table = points.select("key", "size", "text_crc32", *[k.alias(c) for c, k in columns.items()])
    return written(table, "points"), list(columns)


def _leaf_of(node: Node, columns: list[str]) -> Column:
    if not node.children:
        return F.lit(node.first)
    left, right = node.children
    return F.when(F.col(columns[node.dim]) <= node.border, _leaf_of(left, columns)).otherwise(_leaf_of(right, columns))


def _per_node(nodes: list[Node], value) -> Column:
    """``value(node)`` for the node whose number is in column ``node``."""
    chain = F.lit(None)
    for node in nodes:
        chain = F.when(F.col("node") == node.first, F.lit(value(node))).otherwise(chain)
    return chain


def _search(points: DataFrame, nodes: list[Node], columns: list[str]) -> None:
    """Find every node's border: the key with the bytes at or under it nearest to those wanted."""
    chosen = F.lit(None).cast("long")
    for node in nodes:
        chosen = F.when(F.col("node") == node.first, F.col(columns[node.dim])).otherwise(chosen)
    keyed = points.select("node", "size", chosen.alias("key"))
    searching = list(nodes)
    while searching:
        low = _per_node(searching, lambda n: n.low).cast("long")
        high = _per_node(searching, lambda n: n.high).cast("long")
        width = F.floor((high - low) / F.lit(BINS)).cast("long") + 1
        inside = keyed.where((F.col("key") >= low) & (F.col("key") <= high))
        bins = inside.groupBy("node", F.floor((F.col("key") - low) / width).cast("long").alias("bin")).agg(
            F.sum("size").alias("bytes"), F.min("key").alias("least"), F.max("key").alias("most")
        )
        # At most BINS rows per node.
        found = sorted((r["node"], r["bin"], r["bytes"], r["least"], r["most"]) for r in bins.collect())
        for node in searching:
            for _, _, size, least, most in (f for f in found if f[0] == node.first):
                if node.below + size >= node.wanted:
                    node.low, node.high, node.at = least, most, size
                    break
                node.below += size
        for node in searching:
            short, over = node.wanted - node.below, node.below + node.at - node.wanted
            node.border = node.low - 1 if node.below and short < over else node.low
        searching = [n for n in searching if n.low < n.high]


def kd_tree(points: DataFrame, columns: list[str], shards: int) -> Node:
    """The tree over ``points`` (``size`` and integer key ``columns``), which is read many times."""
    root = Node(0, shards)
    level = [root]
    while level := [n for n in level if n.leaves > 1]:
        placed = points.withColumn("node", _leaf_of(root, columns))
        spans = [f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
        seen = {r["node"]: r for r in placed.groupBy("node").agg(F.sum("size").alias("bytes"), *spans).collect()}
        level = [n for n in level if n.first in seen]
        for node in level:
            row, left = seen[node.first], node.leaves // 2
            widths = [row[f"max_{c}"] - row[f"min_{c}"] for c in columns]
            node.dim = widths.index(max(widths))
            node.low, node.high = row[f"min_{columns[node.dim]}"], row[f"max_{columns[node.dim]}"]
            node.wanted = -(-row["bytes"] * left // node.leaves)
        _search(placed, level, columns)
        for node in level:
            left = node.leaves // 2
            node.children = [Node(node.first, left), Node(node.first + left, node.leaves - left)]
        level = [c for n in level for c in n.children]
    return root


def shard(rows: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Per row: ``key``, ``size``, ``text_crc32``, ``law`` ("bytes"), ``shard``, ``slot`` and ``grown_shard`` (null).

    Size is UTF-8 bytes of the text plus 8; a null text has none and counts as empty. Null metadata are lowest.
    Only rows alike in key and all metadata can't be cut apart; repeated rows each get a slot, and other columns aren't read.
    A long text is one row like any other. An empty table gives no rows. Texts are read once; everything after works
    on sizes and metadata.
    """
    points, columns = metadata_points(rows, key, text, lang, source)
    tree = kd_tree(points, columns, shards)
    placed = points.select("key", "size", "text_crc32", F.lit("bytes").alias("law"), _leaf_of(tree, columns).cast("int").alias("shard"))
    slots = numbered(placed, "shard", ["key", "size", "text_crc32"], "slot")
    return slots.select(F.col("key").alias(key), "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
