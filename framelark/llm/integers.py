"""Vectors as whole numbers, for operators whose results are exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sound(vector: str) -> Column:
    """If a vector is there, with at least one component, and none of them is null or non-finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def commonest_size(rows: DataFrame, vector: str, multiple_of: int = 1) -> int | None:
    """The commonest number of components of the sound vectors, the larger of two; only multiples of ``multiple_of``."""
    size = F.size(vector)
    sizes = rows.filter(sound(vector) & (size % multiple_of == 0)).groupBy(size.alias("d")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return first[0]["d"] if first else None


def floored(vector: str, scale: int) -> Column:
    """``floor(scale * x)`` of each component as ``array<int>``.

    Components must be so small that squared distances and inner products fit into 64 bits: their square times the number
    of components stays below 2^60. Larger ones are an error, since no exact result could be given.
    """
    most = F.sqrt(F.lit(float(2**60)) / F.size(vector))

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        large = F.raise_error(F.concat(F.lit("component too large for exact results in 64 bits: "), x.cast("string")))
        return F.when(F.abs(scaled) < most, F.floor(scaled)).otherwise(large).cast("int")

    return F.transform(vector, whole)


def matrix(batch: pa.RecordBatch, column: str, width: int, dtype: type = np.int64) -> np.ndarray:
    """A column of lists of ``width`` numbers, none of them null, as rows of a matrix."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, width)


def lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as a column of lists."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * width, pa.array(np.ascontiguousarray(rows).reshape(-1)))
