"""Gapless numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def numbered(rows: DataFrame, group: str, order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """Number the rows of each ``group`` from 0 in column ``name``, without gaps.

    A group is dealt over ``parts`` hash parts (the session's shuffle partitions by default), counted
    per part, and every part starts where the parts before it end; so no task holds a whole group, and
    the table of starts has at most groups x parts rows. ``rows`` is read twice. Within a part ``order``
    decides; rows equal in it are numbered arbitrarily and should be alike. Column names starting with
    ``_n_`` are reserved. A null group counts as one group.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_n_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    before = Window.partitionBy("_n_group").orderBy("_n_key").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(F.col(group).alias("_n_group"), F.col("_n_part").alias("_n_key"))
        .agg(F.count("*").alias("_n_rows"))
        .withColumn("_n_start", F.coalesce(F.sum("_n_rows").over(before), F.lit(0)))
        .drop("_n_rows")
    )
    within = Window.partitionBy(group, "_n_part").orderBy(*order)
    return (
        dealt.withColumn("_n_row", F.row_number().over(within) - 1)
        .join(starts, F.col(group).eqNullSafe(F.col("_n_group")) & (F.col("_n_part") == F.col("_n_key")))
        .withColumn(name, (F.col("_n_start") + F.col("_n_row")).cast("long"))
        .drop("_n_part", "_n_row", "_n_group", "_n_key", "_n_start")
    )
