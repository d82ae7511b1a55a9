"""Sets of source rows by their place, as bit maps small enough to go to the rows instead of the rows coming to them.

The rows of a shard are cut into containers of ``CONTAINER`` places. A container has one bit for each place, without the
zero bytes at its end, and is only there where something has to be known of it; one of which every row is lost says so
without any bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits in a bit map of Spark's functions.
CONTAINER = 32_768


def container_of(place: str) -> Column:
    return F.call_function("div", F.col(place), F.lit(CONTAINER)).cast("bigint")


def bit_of(place: str) -> Column:
    return F.pmod(F.col(place), F.lit(CONTAINER)).cast("int")


def _byte(bits: Column, n: Column) -> Column:
    """The n-th byte (from 0) as a number, 0 beyond the end."""
    digits = F.hex(F.substring(bits, n + 1, F.lit(1)))
    return F.coalesce(F.conv(F.nullif(digits, F.lit("")), 16, 10).cast("int"), F.lit(0))


def has_bit(bits: Column, bit: Column) -> Column:
    """If a bit is set; null has none."""
    byte = _byte(bits, F.shiftright(bit, 3))
    return F.call_function("shiftright", byte, bit.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1)) == 1


def bits_before(bits: Column, bit: Column) -> Column:
    """How many bits are set before this one."""
    n = F.shiftright(bit, 3)
    whole = F.bitmap_count(F.substring(bits, F.lit(1), n))
    below = F.call_function("shiftleft", F.lit(1), bit.bitwiseAND(F.lit(7))) - 1
    return whole + F.bit_count(_byte(bits, n).bitwiseAND(below))


def _trimmed(bits: str, last: str) -> Column:
    return F.substring(F.col(bits), F.lit(1), F.shiftright(F.col(last), 3) + 1)


def row_containers(rows: DataFrame, wanted: DataFrame, numbered: Column) -> DataFrame:
    """What the rows of each container have to know: which of them are not wanted, and how to number them.

    ``rows`` are all rows in question and ``wanted`` those to keep, both with ``shard`` and ``row_pos``; ``numbered`` says
    of which rows the number among the ``rows`` of their shard is needed. Returns ``shard``, ``container``, ``none`` (no row is
    wanted), ``lost`` (bits of the others), ``members`` (bits of all rows, if a number is needed) and ``earlier`` (rows of
    the shard before this container); containers of which nothing has to be known are left out.
    """
    keep = wanted.select("shard", "row_pos").distinct().withColumn("_wanted", F.lit(True))
    known = rows.select("shard", "row_pos", numbered.alias("_numbered")).join(keep, ["shard", "row_pos"], "left")
    lost = F.col("_wanted").isNull()
    bit = bit_of("row_pos")
    found = known.groupBy("shard", container_of("row_pos").alias("container")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(lost).alias("_n_lost"),
        F.bitmap_construct_agg(F.when(lost, bit)).alias("_lost"),
        F.max(F.when(lost, bit)).alias("_last_lost"),
        F.bool_or("_numbered").alias("_number"),
        F.bitmap_construct_agg(bit).alias("_members"),
        F.max(bit).alias("_last"),
    )
    before = Window.partitionBy("shard").orderBy("container").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("earlier", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint"))
    none = F.col("_n_lost") == F.col("_n")
    return found.filter((F.col("_n_lost") > 0) | F.col("_number")).select(
        "shard",
        "container",
        none.alias("none"),
        F.when(~none & (F.col("_n_lost") > 0), _trimmed("_lost", "_last_lost")).alias("lost"),
        F.when(~none & F.col("_number"), _trimmed("_members", "_last")).alias("members"),
        "earlier",
    )
