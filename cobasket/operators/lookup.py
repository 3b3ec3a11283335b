"""Joining many rows to a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

_SLOT = "__slot"


def look_up(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``table`` so that a key with a large share of the rows can be split.

    Where the table is small enough, Spark broadcasts it. Otherwise both sides are exchanged by key,
    and adaptive execution splits an oversized partition of the rows, but only if it sees a plain
    exchange on either side. A table that was itself grouped by the keys has none: it would be used
    in the partitioning it already has. The extra key, a function of the others, gives it one, at
    the cost of moving the small side once. It is always zero, which Spark can't know and which hardly
    takes a byte of a compressed row; a hash itself would take eight of each.
    """
    slot = F.xxhash64(*keys).bitwiseAND(F.lit(0))
    return (
        rows.withColumn(_SLOT, slot).join(table.withColumn(_SLOT, slot), [*keys, _SLOT], how).drop(_SLOT)
    )
