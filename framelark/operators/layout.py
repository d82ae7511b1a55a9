"""Global order without a single-task window, and windows over groups too large for one task.

``df.orderBy(...)`` range-partitions rows evenly whatever the keys look like. A row's place is (sorted partition, row in
it), written down with the row, and only one small row per partition has to be looked at to turn that into a global
number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelark.session import staged


def _sorted_parts(df: DataFrame, order_by: list[str | Column], parts: int | None) -> DataFrame:
    """Rows in global order as a written table, with ``_part`` (sorted partition) and ``_pos`` (row in it)."""
    if parts is None:
        ordered = df.orderBy(*order_by)
    else:
        ordered = df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
    # The id holds the number of the sorted partition in its upper bits and that of the row in it in the lower 33.
    table = staged(ordered.withColumn("_place", F.monotonically_increasing_id()), "sorted")
    part, pos = F.shiftright("_place", 33).cast("int"), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return table.select(*df.columns, part.alias("_part"), pos.alias("_pos"))


def with_row_index(
    df: DataFrame,
    order_by: list[str | Column],
    within: list[str] | None = None,
    name: str = "row_index",
    parts: int | None = None,
) -> DataFrame:
    """Add a dense 0-based row number in the given order, overall or per group of ``within``.

    ``order_by`` must leave no ties. Rows are sorted globally, so a large group is spread over sorted partitions like
    any other rows; only the first group of a partition can have begun in an earlier one, and gets the number of its
    rows there, one number per partition. ``parts`` fixes the number of partitions. Keep wide columns (media bytes) out
    of ``df``.
    """
    within = within or []
    rows = _sorted_parts(df, [*within, *order_by], parts)
    runs = rows.groupBy("_part", *within).agg(F.min("_pos").alias("_start"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = runs.withColumn("_carry", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).filter("_start = 0")
    # One row for each sorted partition.
    carried = F.broadcast(carried.select(F.col("_part").alias("_in"), "_carry"))
    if within:
        in_part = Window.partitionBy("_part").orderBy("_pos")
        key = F.struct(*within)
        begins = (F.col("_pos") == 0) | ~F.lag(key).over(in_part).eqNullSafe(key)
        rows = rows.withColumn("_begins", begins).withColumn(
            "_begin", F.max(F.when(F.col("_begins"), F.col("_pos"))).over(in_part.rowsBetween(Window.unboundedPreceding, 0))
        )
    else:
        rows = rows.withColumn("_begin", F.lit(0).cast("bigint"))
    place = F.col("_pos") - F.col("_begin") + F.when(F.col("_begin") == 0, F.col("_carry")).otherwise(0)
    return rows.join(carried, F.col("_part") == F.col("_in")).select(*df.columns, place.alias(name))


def _looking_back(keys: list[str], values: dict[str, str]):
    """For Arrow batches in order: of each row the part and place, whether the row before it in the part has the same
    keys, and the values of that row. Columns move as a whole; nothing is done row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place, before = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue

            def shifted(name: str) -> pa.Array:
                column = batch.column(name)
                first = pa.nulls(1, column.type) if before is None else before.column(name)
                return pa.concat_arrays([first, column.slice(0, n - 1)])

            same = pa.array([True] * n)
            for key in keys:
                old, new = shifted(key), batch.column(key)
                equal = pc.fill_null(pc.equal(old, new), False)
                same = pc.and_(same, pc.or_(equal, pc.and_(pc.is_null(old), pc.is_null(new))))
            added = [
                pa.array([part] * n, pa.int32()),
                pa.array(range(place, place + n), pa.int64()),
                same,
                *[shifted(old) for old in values.values()],
            ]
            names = ["_part", "_pos", "_same", *[f"_v{i}" for i in range(len(values))]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])
            place, before = place + n, batch.slice(n - 1, 1)

    return run


def with_previous(
    df: DataFrame, keys: list[str], order_by: list[str], values: dict[str, str], parts: int | None = None
) -> DataFrame:
    """Add values of the previous row of the same key: ``values`` maps new columns to the ones looked back at.

    Rows are sorted globally, once, and looked back at in their sorted partition before it is written. So a key with most of the rows
    is spread like all others, and the rows are shuffled no second time: only the first row of a partition needs the last
    one of the partition before, one row per partition. ``parts`` fixes the number of partitions. Keys are of plain types.
    """
    order = [*keys, *order_by]
    ordered = df.orderBy(*order) if parts is None else df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kinds = [f"_v{i} {df.schema[old].dataType.simpleString()}" for i, old in enumerate(values.values())]
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    schema = ", ".join([*own, "_part int, _pos bigint, _same boolean", *kinds])
    rows = staged(ordered.mapInArrow(_looking_back(keys, values), schema), "sorted")
    known = F.struct(F.struct(*keys).alias("key"), *[F.col(old).alias(f"v{i}") for i, old in enumerate(values.values())])
    # One row for each sorted partition: the window over them is small.
    ends = rows.groupBy("_part").agg(F.max_by(known, F.col("_pos")).alias("_end"))
    before = ends.select(F.col("_part").alias("_in"), F.lag("_end").over(Window.orderBy("_part")).alias("_end"))
    looked = rows.join(F.broadcast(before), F.col("_part") == F.col("_in"))
    first = F.col("_pos") == 0
    same = F.when(first, F.col("_end")["key"].eqNullSafe(F.struct(*keys))).otherwise(F.col("_same"))
    found = [F.when(same, F.when(first, F.col("_end")[f"v{i}"]).otherwise(F.col(f"_v{i}"))).alias(new) for i, new in enumerate(values)]
    return looked.select(*df.columns, *found)


def with_running_total(counts: DataFrame, order_by: str, value: str, name: str, block: int = 1024) -> DataFrame:
    """Running total of an already aggregated column, by an integer order column.

    Totals inside blocks of ``block`` consecutive orders, plus the sum of all earlier blocks.
    """
    cut = counts.withColumn("_block", F.col(order_by) - F.col(order_by) % block)
    inside = Window.partitionBy("_block").orderBy(order_by).rowsBetween(Window.unboundedPreceding, 0)
    # One row per block of shards: the only rows that meet in one task.
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        cut.groupBy("_block")
        .agg(F.sum(value).alias("_n"))
        .select("_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    found = cut.withColumn("_inside", F.sum(value).over(inside)).join(blocks, "_block")
    return found.withColumn(name, (F.col("_inside") + F.col("_before")).cast("bigint")).drop("_block", "_inside", "_before")
