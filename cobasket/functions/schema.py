"""Column pruning at the schema level: what is not in the schema is never parsed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T


def narrow(
    schema: T.StructType, select: Sequence[str] | None = (), drop: Sequence[str] | None = ()
) -> T.StructType:
    """Keep the selected top-level fields, in schema order, then remove the dotted paths in ``drop``.

    An empty ``select`` keeps everything. A path may lead through structs and arrays of structs. The
    given schema is left untouched.
    """
    kept = T.StructType([f for f in schema.fields if not select or f.name in select])
    for path in drop or ():
        kept = _without(kept, path.split("."), path)
    return kept


def _without(node: T.DataType, steps: list[str], path: str) -> T.DataType:
    if isinstance(node, T.ArrayType):
        return T.ArrayType(_without(node.elementType, steps, path), node.containsNull)
    if not isinstance(node, T.StructType):
        raise ValueError(f"cannot drop {path!r}: {steps[0]!r} is not inside a struct")
    head, rest = steps[0], steps[1:]
    if rest and head not in node.fieldNames():
        raise ValueError(f"cannot drop {path!r}: there is no field {head!r}")
    out = T.StructType()
    for field in node.fields:
        if field.name != head:
            out.add(field)
        elif rest:
            out.add(field.name, _without(field.dataType, rest, path), field.nullable, field.metadata)
    return out
