"""Parameters of the two suggestion modes."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Tuning:
    """Thresholds and score parameters of one run.

    ``min_amf`` and ``min_nmf`` stay doubles: a pair count is compared with 2.1, which means
    three links or more. ``pair_buckets``, a number of hash buckets, is worth setting where few of many pairs reach
    ``min_amf``; ``catalog_bits``, the bits of a Bloom filter of the catalog, where many rows are of items outside a catalog
    too large to broadcast. Both change the work alone.
    """

    alpha: float
    adjust: float = 2.0
    min_amf: float = 2.1
    min_nmf: float = 0.4
    max_similar: int = 40
    max_user_events: int = 1000
    pair_buckets: int = 0
    catalog_bits: int = 0

    def with_overrides(self, **overrides) -> Tuning:
        """Return a copy with some fields replaced; text values are parsed to the field's type."""
        types = {f.name: int if f.type == "int" else float for f in fields(self)}
        unknown = sorted(set(overrides) - set(types))
        if unknown:
            raise ValueError(f"unknown tuning {unknown}; known are {sorted(types)}")
        return replace(self, **{name: types[name](value) for name, value in overrides.items()})


# The default tuning of each mode.
PURCHASE_TUNING = Tuning(alpha=0.2)
ORDER_TUNING = Tuning(alpha=0.1)
