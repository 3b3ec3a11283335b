"""Score expressions. All of them are plain columns, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def similarity_level(
    nmf: Column, freq_rec: Column, freq_ref: Column, alpha: float = 0.1, adjust: float = 2.0
) -> Column:
    """Absolute similarity level of a suggested item for a reference item.

    The base is the shared weight per link of the reference item, damped by the popularity of the
    suggested item: ``nmf / (freq_ref * freq_rec ** alpha)``. A logistic factor between 0 and 2
    then pulls down items that are far more frequent than the evidence supports. A zero frequency
    gives null.
    """
    base = F.try_divide(nmf, freq_ref * F.pow(freq_rec, F.lit(float(alpha))))
    evidence = F.try_divide(nmf * freq_ref, F.pow(freq_rec, F.lit(2.0)))
    logistic = F.lit(2.0) / (F.lit(1.0) + F.exp(F.lit(-float(adjust)) * (evidence * F.lit(100.0) - F.lit(1.0))))
    return base * logistic


def bound(value: Column) -> Column:
    """Squash a non-negative value into [0, 1); zero stays zero."""
    log = F.log1p(value)
    return log / (F.lit(1.0) + log)
