"""Clusters of vectors around centroids, exact in whole numbers, with a table of distances to pivots (LAESA).

A few fixed vectors are pivots. The squared distance of every vector to every pivot is computed once and stored beside
it. In each round the centroids' distances to the pivots are computed too, and by the triangle inequality the difference
of the two distances to one pivot is a lower bound of the distance between vector and centroid; the largest over all
pivots counts. The centroid with the least bound is compared exactly first, and after that only those whose bound does
not exceed the best distance so far. Bounds are taken a little lower than computed, so rounding loses none.

Each round reads the table once and passes on one sum per centroid and task; the driver holds the centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm.integers import floored, lists, matrix, sound
from framelark.session import staged

PIVOTS = 16
#: Rows that are compared at a time.
STEP = 8_192
#: Relative error allowed for in bounds; double precision has 2^-53.
SLACK = 2.0**-46


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    apart = x - y
    return np.einsum("ij,ij->i", apart, apart)


def to_points(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all points, a column for each point."""
    return np.stack([squared(x, p) for p in points], axis=1) if len(points) else np.empty((len(x), 0), np.int64)


def spread_out(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the points, each the one whose distances to those before it are largest in sum; the first comes first."""
    chosen, total = [0], np.sqrt(squared(points, points[0]))
    while len(chosen) < min(n, len(points)):
        total[chosen] = -1
        chosen.append(int(total.argmax()))
        total = total + np.sqrt(squared(points, points[chosen[-1]]))
    return points[chosen]


def nearest_centroid(x: np.ndarray, table: np.ndarray, centres: np.ndarray, pivots: np.ndarray):
    """(nearest centroid, squared distance, number of exact comparisons) of each row; ties go to the smaller number.

    ``table`` has the squared distances of the rows to the pivots.
    """
    own, theirs = np.sqrt(table.astype(np.float64)), np.sqrt(to_points(centres, pivots).astype(np.float64))
    bound = np.zeros((len(x), len(centres)))
    for p in range(len(pivots)):
        here, there = own[:, p, None], theirs[None, :, p]
        np.maximum(bound, np.abs(here - there) - (here + there) * SLACK, out=bound)
    bound *= bound * (1 - SLACK)
    label = bound.argmin(axis=1)
    best = squared(x, centres[label])
    compared = np.ones(len(x), np.int32)
    first = label.copy()
    for c, centre in enumerate(centres):
        alive = np.flatnonzero((bound[:, c] <= best) & (first != c))
        distance = squared(x[alive], centre)
        better = (distance < best[alive]) | ((distance == best[alive]) & (c < label[alive]))
        compared[alive] += 1
        label[alive[better]], best[alive[better]] = c, distance[better]
    return label, best, compared


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, STEP):
            yield batch.slice(start, STEP)


def clusters(
    rows: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dimension: int = 64,
    scale: int = 256,
    seed: str = "2:",
    pivots: int = PIVOTS,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, compared``: a row for each vector.

    Components become ``floor(scale * x)``. Centroids begin as the ``k`` vectors with the least SHA-256 of ``seed`` and
    id, in that order (rows of one id by their components, rows without an id last). Each round takes every vector to its
    nearest centroid, ties to the smaller number, and moves each centroid that has vectors to the floor of their exact
    mean. ``distance`` is the squared distance to the centroid after the last round, ``cluster_inertia`` and ``inertia`` its sums,
    ``compared`` how many centroids were compared exactly with the vector.

    Vectors that are null, of another dimension, or hold null or non-finite components take no part; repeated rows are
    vectors each, rows without an id too. Fewer than ``k`` vectors make as many clusters; none make no rows. Components
    too large for exact results in 64 bits are an error (``integers.floored``).
    """
    spark = rows.sparkSession
    kept = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    kept = kept.filter(sound("v") & (F.size("v") == dimension)).select("vec_id", floored("v", scale).alias("x"))
    place = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = kept.withColumn("place", place).orderBy(F.asc_nulls_last("place"), "x").limit(k).collect()
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, compared int"
    if not first:
        return spark.createDataFrame([], out)
    centres = np.array([r["x"] for r in first], np.int64)
    fixed = spread_out(centres, pivots)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            table = lists(to_points(matrix(batch, "x", dimension), fixed))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), table], ["vec_id", "x", "table"])

    index = staged(kept.mapInArrow(measured, "vec_id long, x array<int>, table array<long>"), "pivot-table")

    def summed(centres: np.ndarray):
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros((len(centres), dimension), np.int64), np.zeros(len(centres), np.int64)
            for batch in steps(batches):
                x = matrix(batch, "x", dimension)
                label, _, _ = nearest_centroid(x, matrix(batch, "table", len(fixed)), centres, fixed)
                np.add.at(total, label, x)
                n += np.bincount(label, minlength=len(centres))
            used = np.flatnonzero(n)
            arrays = [pa.array(used.astype(np.int32)), pa.array(n[used]), lists(total[used])]
            yield pa.RecordBatch.from_arrays(arrays, ["cluster", "n", "total"])

        return sums

    for _ in range(rounds):
        found = index.mapInArrow(summed(centres), "cluster int, n long, total array<long>").groupBy("cluster")
        totals = [F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(dimension)]
        centres = centres.copy()
        for row in found.agg(F.sum("n").alias("n"), *totals).collect():
            centres[row["cluster"]] = [row[f"t{i}"] // row["n"] for i in range(dimension)]

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = nearest_centroid(matrix(batch, "x", dimension), matrix(batch, "table", len(fixed)), centres, fixed)
            arrays = [pa.array(a) for a in (found[0].astype(np.int32), found[1], found[2])]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *arrays], ["vec_id", "cluster", "distance", "compared"])

    last = staged(index.mapInArrow(assigned, "vec_id long, cluster int, distance long, compared int"), "clusters")
    inertia = dict(last.groupBy("cluster").agg(F.sum("distance")).collect())
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]

    def of_cluster(values: list, kind: str):
        return F.element_at(F.lit(values).cast(f"array<{kind}>"), F.col("cluster") + 1)

    return last.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster([inertia.get(c, 0) for c in range(len(centres))], "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of_cluster(names, "string").alias("centroid_sha256"),
        "compared",
    )


def clusters_sql(k: int = 40, rounds: int = 5, dimension: int = 64, scale: int = 256, seed: str = "2:") -> str:
    """The same over ``embeddings`` in SQL, every vector compared with every centroid."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
    SELECT rid, cluster, CAST(d AS BIGINT) AS distance FROM (
        SELECT p.rid, c.cluster, sum((p.x - c.x) * (p.x - c.x)) AS d,
               row_number() OVER (PARTITION BY p.rid ORDER BY sum((p.x - c.x) * (p.x - c.x)), c.cluster) AS place
        FROM point p JOIN centre{r} c USING (i) GROUP BY p.rid, c.cluster) WHERE place = 1)""")
        if r < rounds:
            steps.append(f"""centre{r + 1} AS MATERIALIZED (
    SELECT c.cluster, c.i, coalesce(m.x, c.x) AS x FROM centre{r} c LEFT JOIN (
        SELECT cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
            SELECT cluster, i, sum(p.x) AS s, count(*) AS n FROM near{r} JOIN point p USING (rid) GROUP BY cluster, i)) m
        USING (cluster, i))""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = {dimension} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
point AS MATERIALIZED (SELECT rid, unnest(range(1, {dimension + 1})) AS i, unnest(v) AS x FROM kept),
start AS (SELECT rid, row_number() OVER (ORDER BY sha256('{seed}' || vec_id) NULLS LAST, v) - 1 AS cluster FROM kept),
centre0 AS MATERIALIZED (SELECT CAST(cluster AS INTEGER) AS cluster, i, x FROM start JOIN point USING (rid) WHERE cluster < {k}),
{", ".join(steps)},
named AS (SELECT cluster, sha256(string_agg(x, ',' ORDER BY i)) AS centroid_sha256 FROM centre{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near{rounds} JOIN kept USING (rid) JOIN named USING (cluster)
"""
