"""Splitting a manifest over outside workers, and in chunks.

Lines of text are numbered as they are read (``sources.with_line_index``), rows of a table by a global sort. Both have the
number in ``row_index``, and the rest is arithmetic on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.operators.layout import with_row_index
from framelark.schemas import BATCH_SIZE


def dealt(indexed: DataFrame, n: int, base: int = 0, name: str = "shard") -> DataFrame:
    """Deal numbered records round robin over ``n`` shards.

    ``base`` is the number of the first line: 0 deals it to shard 0, 1 to shard 1.
    """
    if n < 1:
        raise ValueError(f"number of shards must be at least 1, got {n}")
    return indexed.withColumn(name, F.pmod(F.col("row_index") + base, F.lit(n)).cast("int"))


def interleaved(df: DataFrame, order_by: list[str | Column], n: int, base: int = 0, name: str = "shard") -> DataFrame:
    """``dealt`` for rows of a table in the given order."""
    return dealt(with_row_index(df, order_by), n, base, name)


def one_shard(df: DataFrame, order_by: list[str | Column], k: int, n: int, base: int = 0) -> DataFrame:
    """The records that round-robin dealing gives to shard ``k``."""
    if not 0 <= k < n:
        raise ValueError(f"shard {k} is not in [0, {n})")
    return interleaved(df, order_by, n, base, "_shard").filter(F.col("_shard") == k).drop("_shard", "row_index")


def hashed(df: DataFrame, key: str, n: int, name: str = "shard") -> DataFrame:
    """Assign records to shards by id. Needs no order and stays put when records are added."""
    return df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))


def sliced(indexed: DataFrame, size: int = BATCH_SIZE, name: str = "chunk") -> DataFrame:
    """Number consecutive slices of ``size`` numbered records; only the last one may be shorter."""
    return indexed.withColumn(name, F.call_function("div", F.col("row_index"), F.lit(size)).cast("bigint"))


def chunked(df: DataFrame, order_by: list[str | Column], size: int = BATCH_SIZE, name: str = "chunk") -> DataFrame:
    """``sliced`` for rows of a table in the given order."""
    return sliced(with_row_index(df, order_by), size, name)
