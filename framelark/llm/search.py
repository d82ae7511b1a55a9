"""Nearest neighbours by inner product, with one-bit codes of randomly rotated vectors.

A vector of length one is rotated at random and each coordinate kept as its sign. The inner product of the vector with
its own code, a number stored beside it, corrects the estimate that the code gives of its inner product with a query;
the same number bounds how far off the estimate is likely to be (``ERROR`` standard widths). Within a shard, the k
vectors with the best estimates are compared exactly; after that a vector is only compared if its upper bound reaches
the worst of them. The error shrinks with the square root of the dimension.

Every row is in the index. Queries meet all rows, block by block: a task holds at most about ``SHARD_ROWS`` vectors and
``QUERY_ROWS`` queries, and passes on k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelark.session import staged

SHARD_ROWS = 16_384
QUERY_ROWS = 8_192
#: Queries whose estimates are held at a time.
STEP = 256
ERROR = 2.0


def rotation(dimension: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dimension, dimension)))
    return q * np.sign(np.diag(r))


def codes(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, lengths, inner products of the unit vectors with their codes) of the rows of ``x``."""
    length = np.linalg.norm(x, axis=1)
    turned = (x / length[:, None]) @ turn.T
    own = np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])
    return np.packbits(turned > 0, axis=1), length, own


def estimates(bits: np.ndarray, length: np.ndarray, own: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimated inner products, widths of their errors), a row for each vector and a column for each turned query."""
    d = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
    rough = signs @ queries.astype(np.float32).T / np.float32(np.sqrt(d))
    scale = (length / own).astype(np.float32)
    spread = length * np.sqrt(np.maximum(1 - own**2, 0)) / own / np.sqrt(max(d - 1, 1))
    return rough * scale[:, None], np.outer(ERROR * spread, np.linalg.norm(queries, axis=1)).astype(np.float32)


def usable(vector: str, dimension: Column | int) -> Column:
    """Vectors that take part: of this dimension, without null or non-finite components, and not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (F.size(vector) == dimension) & fine & F.exists(vector, lambda x: x != 0)


def nearest(
    rows: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` rows with the largest inner product, its own left out.

    Scores are sums of products in double precision of the vectors as given; ties go to the smaller id. Vectors that
    are null, zero, or hold null or non-finite components take no part, nor do rows without an id, nor vectors of
    another dimension than the commonest (the larger of two). Rows with one id are candidates each, but one query, the
    one with the least vector. Queries have fewer rows if there are fewer candidates; no rows give no rows.
    """
    named = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"), is_query.alias("q"))
    named = named.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    sizes = named.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    dimension = sizes[0]["d"] if sizes else 1
    turn = rotation(max(dimension, 1))

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["v"].to_list()).astype(np.float64)
                bits, length, own = codes(x, turn)
                yield pd.DataFrame(
                    {
                        "vec_id": pdf["vec_id"].to_numpy(),
                        "q": pdf["q"].fillna(False).astype(bool).to_numpy(),
                        "v": [v.tobytes() for v in x],
                        "bits": [b.tobytes() for b in bits],
                        "length": length,
                        "own": own,
                    }
                )

    good = named.filter(usable("v", dimension))
    index = staged(good.mapInPandas(coded, "vec_id long, q boolean, v binary, bits binary, length double, own double"), "index")
    n, asked = index.agg(F.count(F.lit(1)), F.count(F.when(F.col("q"), 1))).first()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-asked // QUERY_ROWS))
    place = F.xxhash64("vec_id", "v")

    def every(count: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    data = index.select("*", F.pmod(place, F.lit(shards)).cast("int").alias("shard"), every(blocks, "block")).drop("q")
    asking = index.filter("q").groupBy("vec_id").agg(F.min("v").alias("v"))
    asking = asking.select("vec_id", "v", F.pmod(place, F.lit(blocks)).cast("int").alias("block"), every(shards, "shard"))

    def matched(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = ("query_id", "vec_id", "score")
        if not len(vectors) or not len(queries):
            return pd.DataFrame({name: [] for name in names})
        vectors = vectors.sort_values("vec_id", kind="stable")
        ids, x = vectors["vec_id"].to_numpy(), np.frombuffer(b"".join(vectors["v"]), np.float64).reshape(len(vectors), -1)
        bits = np.frombuffer(b"".join(vectors["bits"]), np.uint8).reshape(len(vectors), -1)
        length, own = vectors["length"].to_numpy(), vectors["own"].to_numpy()
        asked, q = queries["vec_id"].to_numpy(), np.frombuffer(b"".join(queries["v"]), np.float64).reshape(len(queries), -1)
        out = []
        for start in range(0, len(q), STEP):
            part, part_ids = q[start : start + STEP], asked[start : start + STEP]
            guess, width = estimates(bits, length, own, part @ turn.T)
            guess, high = guess.T, (guess + width).T
            for j, query in enumerate(part_ids):
                mine = np.flatnonzero(ids != query)
                if len(mine) > k:
                    likely = mine[np.argpartition(-guess[j][mine], k - 1)[:k]]
                    bar = (x[likely] * part[j]).sum(axis=1).min()
                    mine = mine[high[j][mine] >= np.float32(bar)]
                score = (x[mine] * part[j]).sum(axis=1)
                best = np.lexsort((ids[mine], -score))[:k]
                out.append((np.full(len(best), query), ids[mine][best], score[best]))
        return pd.DataFrame({name: np.concatenate([o[i] for o in out]) for i, name in enumerate(names)})

    found = data.groupBy("shard", "block").cogroup(asking.groupBy("shard", "block")).applyInPandas(
        matched, "query_id long, vec_id long, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
