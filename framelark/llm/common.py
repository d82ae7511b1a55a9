"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n``; a null counts as the empty text (remainder 0)."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of our own beside those of ``df``, which may have any names: underscores are put in front."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray, stream: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on ``x`` and on the number of the stream only."""
    salt = np.uint64((stream * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    return ((mix64(x ^ salt) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def words_of(text: str | None) -> list[bytes]:
    """Runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return."""
    return text.encode().split() if text else []


def chunks_of(pdf: pd.DataFrame, most_bytes: int, column: str = "text") -> Iterator[pd.DataFrame]:
    """Slices of a batch of about ``most_bytes`` of text; a longer text is a slice of its own."""
    sizes = pdf[column].map(lambda t: len(t) if t else 0).to_numpy()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most_bytes:
            yield pdf.iloc[start:i]
            start, held = i, 0
        held += int(n)
    if start < len(pdf):
        yield pdf.iloc[start:]


def squeezed(a: np.ndarray) -> bytes:
    """The array as compressed bytes, first all lowest bytes, then the next ones."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else a.view(np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueezed(data: bytes, dtype: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(flat.reshape(size, -1).T).reshape(-1).view(dtype)


def sum_blobs(df: DataFrame, keys: list[str], value: str, dtype: str = "<f8", fan_in: int = 32) -> DataFrame:
    """Add up equally long arrays kept as bytes, per key, in two steps so that no task reads all of them.

    The first step takes rows of one key from up to ``fan_in`` slots; the second adds the slots' sums. Whoever makes
    the rows should send one per task.
    """

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(pdf[value].iloc[0]) // np.dtype(dtype).itemsize, dtype)
        for blob in pdf[value]:
            total += np.frombuffer(blob, dtype)
        out = pdf[[*keys, "_slot"]].iloc[:1].copy()
        out[value] = [total.tobytes()]
        return out

    slotted = df.select(*keys, F.pmod(F.spark_partition_id(), F.lit(fan_in)).alias("_slot"), value)
    first = slotted.groupBy(*keys, "_slot").applyInPandas(added, slotted.schema)
    # One group of at most ``fan_in`` sums for each key.
    first = first.withColumn("_slot", (F.col("_slot") * 0).cast("int"))
    return first.groupBy(*keys, "_slot").applyInPandas(added, slotted.schema).drop("_slot")


def summed(df: DataFrame, value: str, dtype: str = "<f8", piece_bytes: int = 1 << 19) -> np.ndarray | None:
    """The sum of equally long arrays kept as bytes, or None if there are none.

    They are added up in pieces of ``piece_bytes``, a multiple of the item size: what a task holds at once depends on neither
    the length of the arrays nor how many there are.
    """
    last = F.floor((F.length(value) - 1) / piece_bytes).cast("int")
    numbered = df.select(F.explode(F.sequence(F.lit(0), last)).alias("_piece"), value)
    piece = F.substring(value, F.col("_piece") * piece_bytes + 1, F.lit(piece_bytes))
    rows = sum_blobs(numbered.select("_piece", piece.alias(value)), ["_piece"], value, dtype).collect()
    return np.frombuffer(b"".join(r[value] for r in sorted(rows, key=lambda r: r["_piece"])), dtype) if rows else None
