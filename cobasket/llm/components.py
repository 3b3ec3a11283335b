"""Connected components of links between long node numbers, by contraction within tasks and between them.

Tasks of at most ``PART`` links replace these by stars: every node on the least node that it reaches there. What several tasks
have left is contracted by alternating large and small stars, and so on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cobasket.llm.storage import written
from cobasket.operators.lookup import look_up

# Links held by a task.
PART = 1 << 20


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links that reaches a smaller one, with the least that it reaches."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        next_ = root.copy()
        np.minimum.at(next_, root[u], low)
        np.minimum.at(next_, root[v], low)
        while not np.array_equal(next_, next_[next_]):
            next_ = next_[next_]
        if np.array_equal(next_, root):
            break
        root = next_
    below = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[below], nodes[root[below]]


def _contracted(links: DataFrame, parts: int) -> DataFrame:
    """The links of each of so many tasks as stars."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[batch.column(n).to_numpy() for n in ("a", "b")] for batch in batches]
        if held:
            a, b = least_reached(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return links.repartition(parts).mapInArrow(contract, "a long, b long")


def _least_neighbours(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links seen from both ends, and per node the least of its neighbours and itself."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    return both, both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``links(a, b)``: the least node it reaches.

    Links are contracted within tasks. If they need more than one, large and small stars alternate between
    them, until every node hangs on its root directly; rounds grow with the logarithm of the longest path. Each
    round's links are written to the shared folder, which cuts the lineage. Nodes with many links are split where
    they are looked up. Links of a node with itself and repeated links do no harm; links with a null end don't count; no
    links give no rows.
    """
    links, state = written(links.toDF("a", "b").where("a <> b"), "links"), None
    while (parts := -(-links.count() // PART)) > 0:
        links = written(_contracted(links, parts), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if parts == 1 or now == state:
            break
        state = now
        both, least = _least_neighbours(links)
        # Large star: what is larger than a node goes to the node's least neighbour.
        large = look_up(both.where("v > u"), least, ["u"]).select(F.col("v").alias("a"), F.col("least").alias("b"))
        # Small star: a node and its smaller neighbours go to the least of them.
        down = large.where("a > b").distinct()
        least_below = down.groupBy("a").agg(F.min("b").alias("least"))
        small = look_up(down, least_below, ["a"]).select(F.col("b").alias("a"), F.col("least").alias("b"))
        links = written(least_below.toDF("a", "b").union(small).where("a <> b").distinct(), "links")
    roots = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
