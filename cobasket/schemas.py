"""Declared input and output schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from cobasket.functions.schema import narrow

# The fields of the input and output formats.
PRODUCTS = T.StructType().add("client", "string").add("product_id", "string").add("status", "string")

_PRODUCT = (
    T.StructType()
    .add("id", "string")
    .add("price", "double")
    .add("specs", T.MapType(T.StringType(), T.StringType()))
)

BUYORDER = (
    T.StructType()
    .add("client", "string")
    .add("order_id", "string")
    .add("user_id", "string")
    .add("items", T.ArrayType(T.StructType().add("product", _PRODUCT)))
    .add("date", "string")
    .add("total", "double")
)

SUGGESTIONS = (
    T.StructType()
    .add("client", "string")
    .add(
        "tuning",
        T.StructType().add("nmf", "double").add("alpha", "double").add("adjust", "double").add("amf", "double"),
    )
    .add("product", "string")
    .add(
        "results",
        T.ArrayType(
            T.StructType()
            .add("rec", "string")
            .add("amf", "long")
            .add("nmf", "double")
            .add("freq_rec", "long")
            .add("freq_ref", "long")
            .add("asl", "double")
            .add("nsl", "double")
        ),
    )
)

_KNOWN = {
    ("catalog", "products"): PRODUCTS,
    ("event", "buyorder"): BUYORDER,
    ("algorithm", "suggestions"): SUGGESTIONS,
}


def schema_of(
    source: str, name: str, select: Sequence[str] = (), drop: Sequence[str] = ()
) -> T.StructType:
    """Look up a declared schema and narrow it to the fields a reader needs."""
    if (source, name) not in _KNOWN:
        known = ", ".join(".".join(key) for key in sorted(_KNOWN))
        raise ValueError(f"no schema {source}.{name}; known are {known}")
    return narrow(_KNOWN[source, name], select, drop)
