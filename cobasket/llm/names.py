"""Names for helper columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(rows: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``rows`` has it, in upper or lower case."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name
