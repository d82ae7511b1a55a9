"""Short codes of vectors: each part of a vector becomes the number of the nearest entry of the part's codebook.

The nearest entry is found by slicing and intersecting bit masks. Of each position in a part, the entries' coordinates are
sorted, and beside the sorted coordinates stand prefix masks: bit e of mask i is set if entry e is among the first i. The
entries within a radius of a value at that position are then the difference of two prefix masks, found by two binary
searches. The radius is the exact distance to the best of a few entries that stand next to the value in some position; no
entry that is nearer, or as near, can lie outside it at any position. So the AND of the masks of all positions has all
entries that can win, and only those are compared. Everything is in whole numbers, so results are exact.

Each round reads the table once and passes on one sum per part, entry and task; the driver holds the codebooks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm.clustering import squared, steps
from framelark.llm.integers import commonest_size, floored, lists, matrix, sound
from framelark.session import staged

#: Copies of each label's sum, so that rows of one label meet it in that many places.
SALTS = 32


class Book:
    """Entries of one part, at most 256, with sorted coordinates and prefix masks of each position."""

    def __init__(self, entries: np.ndarray):
        n, self.width = entries.shape
        self.entries, self.words = entries, -(-n // 64)
        bits = np.zeros((n, self.words), np.uint64)
        bits[np.arange(n), np.arange(n) // 64] = np.uint64(1) << (np.arange(n) % 64).astype(np.uint64)
        self.order = [np.argsort(entries[:, j], kind="stable") for j in range(self.width)]
        self.sorted = [entries[order, j] for j, order in enumerate(self.order)]
        none = np.zeros((1, self.words), np.uint64)
        self.prefix = [np.concatenate([none, np.bitwise_or.accumulate(bits[order])]) for order in self.order]

    def radius(self, x: np.ndarray) -> np.ndarray:
        """Of each row, the whole part of an exact distance that some entry has from it."""
        best = np.full(len(x), np.iinfo(np.int64).max)
        for j in range(self.width):
            at = np.searchsorted(self.sorted[j], x[:, j])
            for near in (np.maximum(at - 1, 0), np.minimum(at, len(self.entries) - 1)):
                np.minimum(best, squared(x, self.entries[self.order[j][near]]), out=best)
        root = np.sqrt(best.astype(np.float64)).astype(np.int64)
        root -= root * root > best
        return root + ((root + 1) * (root + 1) <= best)

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Masks of the entries that are within the radius at every position."""
        radius = self.radius(x)
        mask = np.full((len(x), self.words), ~np.uint64(0))
        for j in range(self.width):
            low = np.searchsorted(self.sorted[j], x[:, j] - radius, "left")
            high = np.searchsorted(self.sorted[j], x[:, j] + radius, "right")
            mask &= self.prefix[j][high] & ~self.prefix[j][low]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest entry, squared distance) of each row; ties go to the lower number."""
        packed = np.ascontiguousarray(self.candidates(x).astype("<u8")).view(np.uint8)
        row, entry = np.nonzero(np.unpackbits(packed.reshape(len(x), -1), axis=1, bitorder="little"))
        distance = squared(x[row], self.entries[entry])
        begins = np.flatnonzero(np.diff(row, prepend=-1))
        best = np.minimum.reduceat(distance, begins) if len(begins) else distance
        wins = np.flatnonzero(distance == best[row])
        first = wins[np.flatnonzero(np.diff(row[wins], prepend=-1))]
        return entry[first], best


def coded(x: np.ndarray, books: list[Book]) -> tuple[np.ndarray, np.ndarray]:
    """(entry of every part, squared distances) of each row, a column for each part."""
    parts = np.split(x, len(books), axis=1)
    found = [book.nearest(np.ascontiguousarray(part)) for book, part in zip(books, parts)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def compressed(
    rows: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: a row for each vector.

    Components become ``floor(scale * x)``, and a vector is cut into ``parts`` equal parts. The codebook of a part begins as
    that part of the ``entries`` vectors with the smallest ids (rows of one id by their components, rows without an id last). Each
    round takes every part to its nearest entry, ties to the lower number, and moves each used entry to the floor of the
    exact mean of its parts. ``code`` has two hex digits for each part, ``error`` is the sum of the squared distances,
    ``label_error`` its sum over rows with that label (null labels are one), ``codebooks_sha256`` names the final codebooks.

    Vectors that are null or hold null or non-finite components take no part, nor do those whose number of components is
    not the commonest multiple of ``parts`` (the larger of two): they have no equal parts. Repeated rows are vectors each. Fewer vectors than
    ``entries`` make shorter codebooks; none make no rows. Components too large for exact results in 64 bits are an error.
    """
    if not 1 <= entries <= 256:
        raise ValueError(f"a code has two hex digits, so 1 to 256 entries, got {entries}")
    spark = rows.sparkSession
    named = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    size = commonest_size(named, "v", parts)
    kind = named.schema["label"].dataType.simpleString()
    if size is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    kept = named.filter(sound("v") & (F.size("v") == size)).select("vec_id", "label", floored("v", scale).alias("x"))
    index = staged(kept, "whole-numbers")
    first = index.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).select("x").collect()
    width = size // parts
    # By part, entry, position.
    tables = np.array([r["x"] for r in first], np.int64).reshape(-1, parts, width).transpose(1, 0, 2).copy()

    def summed(tables: np.ndarray):
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books = [Book(t) for t in tables]
            total, n = np.zeros(tables.shape, np.int64), np.zeros(tables.shape[:2], np.int64)
            part = np.arange(parts)
            for batch in steps(batches):
                x = matrix(batch, "x", size)
                codes, _ = coded(x, books)
                np.add.at(total, (part[None, :], codes), x.reshape(len(x), parts, width))
                np.add.at(n, (part[None, :], codes), 1)
            used = np.nonzero(n)
            arrays = [pa.array(used[0].astype(np.int32)), pa.array(used[1].astype(np.int32)), pa.array(n[used]), lists(total[used])]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "n", "total"])

        return sums

    for _ in range(rounds):
        found = index.select("x").mapInArrow(summed(tables), "part int, entry int, n long, total array<long>")
        totals = [F.sum(F.get("total", F.lit(j))).alias(f"t{j}") for j in range(width)]
        moved = tables.copy()
        for row in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect():
            moved[row["part"], row["entry"]] = [row[f"t{j}"] // row["n"] for j in range(width)]
        tables = moved

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Book(t) for t in tables]
        for batch in steps(batches):
            codes, distance = coded(matrix(batch, "x", size), books)
            text = pa.array([row.tobytes().hex() for row in codes.astype(np.uint8)], pa.string())
            arrays = [batch.column("vec_id"), batch.column("label"), text, pa.array(distance.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "code", "error"])

    last = staged(index.mapInArrow(finished, f"vec_id long, label {kind}, code string, error long"), "codes")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    sums = last.groupBy("label").agg(F.sum("error").alias("label_error")).select("label", "label_error", salts)
    dealt = last.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    same = dealt["label"].eqNullSafe(sums["label"]) & (dealt["salt"] == sums["salt"])
    name = hashlib.sha256(",".join(map(str, tables.reshape(-1).tolist())).encode()).hexdigest()
    return dealt.join(sums, same).select("vec_id", "code", "error", "label_error", F.lit(name).alias("codebooks_sha256"))


def compressed_sql(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """The same over ``embeddings`` in SQL, every part compared with every entry."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
    SELECT rid, part, entry, CAST(d AS BIGINT) AS distance FROM (
        SELECT p.rid, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d,
               row_number() OVER (PARTITION BY p.rid, p.part ORDER BY sum((p.x - b.x) * (p.x - b.x)), b.entry) AS place
        FROM point p JOIN book{r} b USING (part, j) GROUP BY p.rid, p.part, b.entry) WHERE place = 1)""")
        if r < rounds:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, b.j, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN (
        SELECT part, entry, j, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
            SELECT part, entry, j, sum(p.x) AS s, count(*) AS n FROM near{r} JOIN point p USING (rid, part)
            GROUP BY part, entry, j)) m USING (part, entry, j))""")
    return f"""
WITH sound AS (
    SELECT row_number() OVER () AS rid, vec_id, label, embedding AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
size AS (SELECT len(v) AS d FROM sound WHERE len(v) % {parts} = 0 GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1),
kept AS MATERIALIZED (
    SELECT rid, vec_id, label, d, list_transform(v, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM sound JOIN size ON len(v) = d),
point AS MATERIALIZED (
    SELECT rid, CAST(i // (d // {parts}) AS INTEGER) AS part, i % (d // {parts}) AS j, x
    FROM (SELECT rid, d, unnest(range(0, d)) AS i, unnest(v) AS x FROM kept)),
start AS (SELECT rid, CAST(row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS INTEGER) AS entry FROM kept),
book0 AS MATERIALIZED (SELECT part, entry, j, x FROM start JOIN point USING (rid) WHERE entry < {entries}),
{", ".join(steps)},
final AS (
    SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(distance) AS BIGINT) AS error
    FROM near{rounds} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(x, ',' ORDER BY part, entry, j)) FROM book{rounds}) AS codebooks_sha256
FROM final JOIN kept USING (rid)
"""
