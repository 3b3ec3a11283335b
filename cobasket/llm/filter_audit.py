"""What every filter of a chain removes, in every order of the filters, by min-plus products.

A row's failures are a mask over the filters. In a mask matrix (0 where a filter is failed, infinity elsewhere) and a
matrix of positions (the inverse of every order), the min-plus product gives the step at which each mask is removed in
each order: the least position of a filter that it fails. Rows only matter through their number and weights per mask, so
one pass counts these per part, and the steps then scatter the counts into what each step of each order removes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cobasket.llm.names import unused
from cobasket.operators.lookup import look_up

# ASCII white space, the edges of words.
_BLANKS = "[ \\t-\\r]+"


def orders_of(filters: int) -> np.ndarray:
    """All orders, one per row, lexicographically: the filter at each step."""
    return np.array(list(permutations(range(filters))), dtype=np.int64)


def removal_steps(orders: np.ndarray) -> np.ndarray:
    """(mask, order): the step from 0 at which rows of a mask go; the number of filters where they stay."""
    filters = orders.shape[1]
    fails = np.arange(1 << filters)[:, None] >> np.arange(filters) & 1
    cost = np.where(fails == 1, 0, filters)
    position = np.argsort(orders, axis=1)
    return np.minimum((cost[:, None, :] + position[None, :, :]).min(axis=2), filters)


def scatter(steps: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(order, step): the summed weights of the masks removed there, kept ones in the last column."""
    masks, orders = steps.shape
    width = int(steps.max(initial=0)) + 1
    out = np.zeros(orders * width, dtype=np.int64)
    np.add.at(out, (np.arange(orders) * width + steps).ravel(), np.repeat(weights, orders))
    return out.reshape(orders, width)


def audit(rows: DataFrame, filters: str, mask: str, part: str, losses: Sequence[str] = ()) -> DataFrame:
    """Per ``part``, order of the filters and step: what is kept after it and what its filter does there.

    ``filters`` has one letter per filter; bit i of the integer column ``mask`` says that a row fails the i-th. ``losses`` are
    columns of 0 and 1, of which removed rows are summed up. Returns ``part``, ``filter_order``, ``step`` (from 1), ``kept``,
    ``removed``, ``redundant`` (rows that fail the filter and went earlier), ``unique_fails`` (that fail this filter
    only), a sum ``<name>_lost`` per loss, and ``shapley`` (what the filter removes in all orders together). The table
    grows with the number of parts alone. Null masks fail nothing, null losses are 0; an empty table gives no rows.
    """
    count, orders = len(filters), orders_of(len(filters))
    steps = removal_steps(orders)
    names = ["".join(filters[i] for i in order) for order in orders]
    outputs = ["kept", "removed", "redundant", "unique_fails", *(f"{x}_lost" for x in losses), "shapley"]
    grouped = rows.groupBy(F.col(part).alias("_part"), F.coalesce(F.col(mask), F.lit(0)).cast("int").alias("_mask")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.coalesce(F.sum(x), F.lit(0)).cast("long").alias(f"_w{i}") for i, x in enumerate(losses)]
    )
    # At most one entry per mask.
    entry = F.struct("_mask", "_rows", *[f"_w{i}" for i in range(len(losses))])
    parts = grouped.groupBy("_part").agg(F.collect_list(entry).alias("_entries"))

    def one_part(entries: list[dict]) -> list[np.ndarray]:
        weights = np.zeros((1 + len(losses), 1 << count), dtype=np.int64)
        for e in entries:
            weights[:, e["_mask"]] = [e["_rows"], *(e[f"_w{i}"] for i in range(len(losses)))]
        fate = [scatter(steps, w) for w in weights]
        gone = fate[0][:, :count] if fate[0].shape[1] > count else np.pad(fate[0], ((0, 0), (0, count - fate[0].shape[1])))
        fails = np.arange(1 << count)[:, None] >> np.arange(count) & 1
        failing, only = weights[0] @ fails, weights[0][1 << np.arange(count)]
        total = np.zeros(count, dtype=np.int64)
        np.add.at(total, orders.ravel(), gone.ravel())
        lost = [f[:, :count] for f in fate[1:]]
        found = [weights[0].sum() - np.cumsum(gone, axis=1), gone, failing[orders] - gone, only[orders], *lost, total[orders]]
        return [x.ravel() for x in found]

    def all_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, entries in zip(batch.column("_part"), batch.column("_entries").to_pylist(), strict=True):
                columns = [pa.array([value.as_py()] * orders.size, batch.schema.field("_part").type)]
                columns += [pa.array(np.repeat(names, count)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(orders)))]
                columns += [pa.array(x) for x in one_part(entries)]
                yield pa.RecordBatch.from_arrays(columns, names=["_part", "filter_order", "step", *outputs])

    kind = grouped.schema["_part"].dataType.simpleString()
    schema = f"_part {kind}, filter_order string, step int, " + ", ".join(f"`{n}` long" for n in outputs)
    return parts.mapInArrow(all_parts, schema).withColumnRenamed("_part", part)


def text_failures(text: Column) -> list[Column]:
    """What can be said of a text by itself: too short, repetitive, many capitals, markup characters.

    Words are runs of anything but ASCII white space; a null text has none.
    """
    content = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(content, _BLANKS), lambda w: w != "")
    many, different = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(content, "[^A-Z]+", ""))
    return [
        many < 50,
        100 * different.cast("long") < 65 * many.cast("long"),
        100 * capitals.cast("long") > 5 * F.char_length(content).cast("long"),
        content.rlike("[#$%&*|]"),
    ]


def with_failures(rows: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(``part``, ``mask``, ``good``, ``toxic``) of every row; bits A to D of the mask are ``text_failures``.

    Bit E says that a row with a smaller key has the same text, as told by its SHA-256; null texts are empty. Null keys
    neither fail E nor make others fail it, nor do rows of equal keys among each other. A null part becomes ''. Of several
    labels of a key, any 1 counts; rows without a label count as neither good nor toxic.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    digest, first = unused(rows, "_digest"), unused(rows, "_first")
    bits = [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(text_failures(F.col(text)))]
    narrow = rows.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(content.cast("binary"), 256)).alias(digest),
        sum(bits[1:], bits[0]).alias("own"),
    )
    # Texts are read twice, narrowly here; neither pass moves them.
    seen = rows.select(F.unhex(F.sha2(content.cast("binary"), 256)).alias(digest), F.col(key).alias("key"))
    firsts = seen.groupBy(digest).agg(F.min("key").alias(first), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    found = look_up(narrow, firsts.drop("copies"), [digest], "left")
    again = F.when(F.col("key") > F.col(first), F.lit(1 << 4)).otherwise(F.lit(0))
    marks = labels.groupBy(F.col("doc_id").alias("key")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    found = found.select("key", "part", (F.col("own") + again).alias("mask"))
    marked = look_up(found, marks, ["key"], "left")
    return marked.select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def audit_documents(rows: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """:func:`audit` of the filters A to E over whole texts, with ``part`` as a column of that name.

    Odd rows: see :func:`with_failures`. Long texts are counted whole; repeated rows count each; other columns aren't read; an
    empty table gives no rows.
    """
    return audit(with_failures(rows, labels, key, text, part), "ABCDE", "mask", "part", ("good", "toxic"))
