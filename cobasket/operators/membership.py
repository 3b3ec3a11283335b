"""Bloom filters of keyed tables, to leave out rows before they are exchanged.

A table too large to broadcast still says in a few bits per key which keys it can't hold. Its keys are hashed to
places in a bit array on the cluster, and the array, a fixed number of bytes, comes back as a scalar subquery in a
plain filter: one lazy plan, no Python. Rows whose key is in the table always pass, a few others pass too, so the
filter goes ahead of a join, never in its place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Hashes per key; three suit arrays of five to ten bits per key, which let through 9 to 2 rows in 100.
SEEDS = (17, 18, 19)
WORD = 64


def _places(keys: Sequence[str], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(bits)) for seed in SEEDS]


def bit_array(table: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """One row with the array ``words`` of ``bits / 64`` longs, in which the places of all keys are set.

    Bits are combined map-side, at most one row per word and task is exchanged, and the last step sorts exactly
    ``bits / 64`` words whatever the size of the table.
    """
    if bits < WORD or bits % WORD:
        raise ValueError(f"the number of bits must be a positive multiple of {WORD}, not {bits}")
    place = table.select(F.explode(F.array(*_places(keys, bits))).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(WORD)).cast("int"))
    masks = place.select(F.floor(F.col("place") / F.lit(WORD)).cast("long").alias("word"), bit.alias("mask"))
    empty = table.sparkSession.range(bits // WORD).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    words = masks.unionByName(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "mask")))
    return words.agg(in_order["mask"].alias("words"))


def possibly_in(rows: DataFrame, table: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """``rows`` without most of those whose ``keys`` aren't in ``table``; none that are in it are lost.

    Null keys are hashed like values, so they pass where the table has them. ``bits`` bounds what each task is sent.
    """
    words = bit_array(table, keys, bits).scalar()
    for place in _places(keys, bits):
        word = F.get(words, F.floor(place / F.lit(WORD)).cast("int"))
        shifted = F.call_function("shiftrightunsigned", word, F.pmod(place, F.lit(WORD)).cast("int"))
        rows = rows.filter(shifted.bitwiseAND(F.lit(1).cast("long")) == 1)
    return rows
