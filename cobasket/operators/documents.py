"""Nested suggestion documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cobasket.schemas import SUGGESTIONS
from cobasket.tuning import Tuning

# Members of one result in output order.
RESULT_FIELDS = tuple(SUGGESTIONS["results"].dataType.elementType.fieldNames())


def result_arrays(ranked: DataFrame) -> DataFrame:
    """One row per item with its results, best first: ``(client, item_ref, results)``.

    Arrays hold at most the K of the ranking and reuse its partitioning, so nothing moves.
    """
    sortable = F.struct(
        "nsl", F.col("item_rec").alias("rec"), *[name for name in RESULT_FIELDS if name not in ("nsl", "rec")]
    )
    in_order = F.sort_array(F.collect_list(sortable), asc=False)
    return ranked.groupBy("client", "item_ref").agg(
        F.transform(in_order, lambda r: F.struct(*[r[name].alias(name) for name in RESULT_FIELDS])).alias("results")
    )


def suggestion_documents(arrays: DataFrame, tuning: Tuning) -> DataFrame:
    """The emitted document: client, tuning of the run, product and its results."""
    used = {"nmf": tuning.min_nmf, "alpha": tuning.alpha, "adjust": tuning.adjust, "amf": tuning.min_amf}
    return arrays.select(
        "client",
        F.struct(*[F.lit(float(value)).alias(name) for name, value in used.items()]).alias("tuning"),
        F.col("item_ref").alias("product"),
        "results",
    )
