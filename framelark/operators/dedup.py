"""One row, or k rows, per key.

``row_number() <= k`` over a key is pruned inside each map task before the shuffle (WindowGroupLimit), so a key
that holds a third of all rows sends at most k rows per task, not its whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_columns(order_by: list[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def top_per_group(df: DataFrame, keys: list[str], order_by: list[str | Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each key in the given order, with their rank from 1."""
    w = Window.partitionBy(*keys).orderBy(*_as_columns(order_by))
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """First-wins: the earliest row of each key. ``order_by`` must leave no ties."""
    return top_per_group(df, keys, order_by, 1, "_rank").drop("_rank")


def last_per_key(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """Last-wins: the latest row of each key. ``order_by`` must leave no ties."""
    latest_first = [c.desc_nulls_last() for c in _as_columns(order_by)]
    return top_per_group(df, keys, latest_first, 1, "_rank").drop("_rank")


def last_with_first_seen(df: DataFrame, key: str, order_by: list[str], value: str) -> DataFrame:
    """Last value of each key, with the place where the key was first seen and how many rows it had.

    One aggregate with a map-side part, so one shuffle and one row per key and task.
    """
    place = F.struct(*order_by)
    found = df.groupBy(key).agg(
        F.max_by(value, place).alias(value),
        F.min(place).alias("first_seen"),
        F.max(place).alias("last_seen"),
        F.count(F.lit(1)).alias("n_records"),
    )
    return found
