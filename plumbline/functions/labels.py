"""Labels, tiers and conditional counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def label(value: Column, labels: Mapping[str, object], other: object) -> Column:
    """Look ``value`` up in ``labels``; NULL and unknown values get ``other``."""
    expression = F
    for key, text in labels.items():
        expression = expression.when(value == key, text)
    return expression.otherwise(other)


def tier_below(value: Column, bounds: Sequence[tuple[float, str]], rest: str) -> Column:
    """First tier whose bound lies above ``value``; NULL falls to ``rest``."""
    expression = F
    for bound, name in bounds:
        expression = expression.when(value < bound, name)
    return expression.otherwise(rest)


def tier_from(value: Column, bounds: Sequence[tuple[float, str]], rest: str) -> Column:
    """First tier whose bound ``value`` reaches; NULL falls to ``rest``."""
    expression = F
    for bound, name in bounds:
        expression = expression.when(value >= bound, name)
    return expression.otherwise(rest)


def conditional_count(condition: Column) -> Column:
    """Number of rows on which ``condition`` holds; NULL over no rows at all."""
    return F.sum(F.when(condition, 1).otherwise(0))
