"""Small inputs and a plain-Python statement of the two jobs to compare with."""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession

from cobasket.schemas import BUYORDER, PRODUCTS

EDGE_TYPES = "client string, item_ref string, item_rec string, amf long, nmf double, freq_ref long, freq_rec long"


def catalog(spark: SparkSession, statuses: dict[str, str] | list[tuple[str, str]], client: str = "c1") -> DataFrame:
    pairs = statuses.items() if isinstance(statuses, dict) else statuses
    return spark.createDataFrame([(client, item, status) for item, status in pairs], PRODUCTS)


def event(user, order, items, client="c1"):
    wrapped = None if items is None else [None if i is None else ((i, 1.0, {"k": "v"}),) for i in items]
    return (client, order, user, wrapped, "2022-04-03", 1.0)


def events(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([event(*row) for row in rows], BUYORDER)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def brute_force_edges(statuses, orders, mode, cap, min_amf, min_nmf):
    """``{(client, ref, rec): (amf, nmf, freq_ref, freq_rec)}`` of ``(user, order, items[, client])`` rows."""
    seen = set()
    for user, order, items, *rest in orders:
        client = rest[0] if rest else "c1"
        for item in items or []:
            if statuses.get(item) in ("AVAILABLE", "UNAVAILABLE") and user is not None:
                link = user if mode == "purchase" else (None if order is None else (user, order))
                seen.add((client, user, link, item))
    totals, links_of, items_of = defaultdict(int), defaultdict(set), defaultdict(set)
    for client, user, link, item in seen:
        totals[client, user] += 1
        if link is not None:
            links_of[client, item].add(link)
            items_of[client, user, link].add(item)
    amf, weight = defaultdict(int), defaultdict(list)
    for (client, user, _), items in items_of.items():
        if not 2 <= totals[client, user] <= cap:
            continue
        kept = sorted(i for i in items if len(links_of[client, i]) > 1)
        for x in range(len(kept)):
            for y in range(x + 1, len(kept)):
                key = client, kept[x], kept[y]
                amf[key] += 1
                weight[key].append(2 / totals[client, user])
    out = {}
    for key, n in amf.items():
        nmf = round(math.fsum(weight[key]), 12)
        if n >= min_amf and nmf >= min_nmf:
            client, ref, rec = key
            out[key] = (n, nmf, len(links_of[client, ref]), len(links_of[client, rec]))
    return out


def as_edges(df: DataFrame) -> dict:
    found = df.select("client", "item_ref", "item_rec", "amf", "nmf", "freq_ref", "freq_rec").collect()
    out = {(r.client, r.item_ref, r.item_rec): (r.amf, round(r.nmf, 9), r.freq_ref, r.freq_rec) for r in found}
    assert len(out) == len(found), "an edge appears twice"
    return out


def rounded(edges: dict) -> dict:
    return {k: (a, round(n, 9), f, g) for k, (a, n, f, g) in edges.items()}


def executed_nodes(df):
    """All nodes of the executed plan of ``df``, which has been collected."""
    stack = [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        yield node
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            stack.append(node.plan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]


def exchanges(df):
    """``(rows, bytes)`` that each exchange of the executed plan of ``df`` has written, those used twice counted once."""
    found = {}
    for node in executed_nodes(df):
        if node.nodeName() == "Exchange":
            records, size = (node.metrics().apply(name) for name in ("shuffleRecordsWritten", "shuffleBytesWritten"))
            found[records.id()] = records.value(), size.value()
    return sorted(found.values())
