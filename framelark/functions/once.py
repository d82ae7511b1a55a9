"""Keeping a costly expression from being computed again by every expression that uses it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(expression: Column) -> Column:
    """The same value, computed once per row.

    The optimizer copies a column's expression into each filter and projection above it; it does not copy out of an
    explode. One-element arrays keep the rows as they are, null values too.
    """
    return F.explode(F.array(expression))
