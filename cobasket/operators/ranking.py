"""Scoring of directed edges and the best K per item."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cobasket.functions.scores import similarity_level


def scored(edges: DataFrame, alpha: float, adjust: float) -> DataFrame:
    """Add the absolute similarity level ``asl``."""
    return edges.withColumn(
        "asl", similarity_level(F.col("nmf"), F.col("freq_rec"), F.col("freq_ref"), alpha, adjust)
    )


def best_per_item(edges: DataFrame, k: int) -> DataFrame:
    """Keep the ``k`` best suggestions of each item, with their ``rank``.

    Ties go to the higher item id. In this form Spark cuts to ``k`` rows per item before the
    exchange as well, so a popular item does not gather all its edges.
    """
    order = Window.partitionBy("client", "item_ref").orderBy(F.desc("asl"), F.desc("item_rec"))
    return edges.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def normalised(ranked: DataFrame) -> DataFrame:
    """Add ``nsl``, the score relative to the best one of the item."""
    best = F.max("asl").over(Window.partitionBy("client", "item_ref"))
    return ranked.withColumn("nsl", F.try_divide("asl", best))


def ranked_similar(edges: DataFrame, alpha: float, adjust: float, k: int) -> DataFrame:
    """Score, rank, cut and normalise; the cut keeps rank 1, hence the maximum."""
    return normalised(best_per_item(scored(edges, alpha, adjust), k))
