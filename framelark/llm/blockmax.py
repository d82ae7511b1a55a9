"""Exact top-k search by inner product, block by block in the order of upper bounds.

Vectors are documents, their positions are terms and their whole-number components the terms' weights. Documents are put
in an order in which similar ones are neighbours and cut into ranges of ``BLOCK``. A block has a forward index, the
weights of its documents, and for every term the largest and the smallest weight in it. A query's bound of a block is
the sum over its terms of weight times largest (for weights below zero, smallest); no document of the block can score more.

A query takes the blocks of a shard in descending order of bounds, a few at a time and twice as many each time, scores their
documents by the forward index, and ends where bounds fall below its k-th score. Blocks whose bound equals it are
scored, since ties go to the smaller id. A query first searches the shard that holds its own row; the k-th score
found there is where the search of all other shards begins.

Every document is in the index and every query meets every shard, in tasks of at most ``SHARD_ROWS`` documents and
``QUERY_ROWS`` queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelark.llm.integers import commonest_size, floored, matrix, sound
from framelark.session import staged

BLOCK = 32
SHARD_ROWS = 65_536
#: Small tables are cut into about this many shards, so that all cores have work.
LEAST_SHARDS, LEAST_SHARD_ROWS = 64, 2_048
QUERY_ROWS = 16_384
#: Queries whose bounds are held at a time.
STEP = 1_024
#: Documents that stand for the neighbourhoods of the order: the bounded sample it is made from.
LEADERS = 256
NOTHING = np.iinfo(np.int64).min


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``x`` and ``q``; in double precision where no sum can be rounded there."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    if most < 2**53:
        return (x.astype(np.float64) @ q.astype(np.float64).T).astype(np.int64)
    return x.astype(np.int64) @ q.astype(np.int64).T


def upper_bounds(high: np.ndarray, low: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Bounds of all blocks (rows) for all queries (columns)."""
    return products(high, np.maximum(q, 0)) + products(low, np.minimum(q, 0))


def best_of(query: np.ndarray, vec_id: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each query, by query and rank."""
    order = np.lexsort((vec_id, -score, query))
    begin = np.flatnonzero(np.diff(query[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    return order[rank < k]


class Shard:
    """Blocks one after the other: forward indexes, ids, and the largest and smallest weights of each block's terms."""

    def __init__(self, ids: list[bytes], forward: list[bytes], high: list[bytes], low: list[bytes], width: int):
        self.ids = [np.frombuffer(b, np.int64) for b in ids]
        self.forward = [np.frombuffer(b, np.int32).reshape(-1, width) for b in forward]
        self.high = np.frombuffer(b"".join(high), np.int32).reshape(-1, width)
        self.low = np.frombuffer(b"".join(low), np.int32).reshape(-1, width)

    def search(self, ask: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int):
        """(places of queries, ids, scores, number of documents scored) of the ``k`` best documents of each query.

        ``ask`` has the queries' ids, whose own rows are no candidates. Documents below ``floor`` may be left out.
        """
        bound = upper_bounds(self.high, self.low, q).T
        order = np.argsort(-bound, axis=1, kind="stable")
        kth = floor.copy()
        held = (np.empty(0, np.int64),) * 3
        scored, start, many = 0, 0, 1
        while start < order.shape[1]:
            blocks = order[:, start : start + many]
            who, at = np.nonzero(np.take_along_axis(bound, blocks, axis=1) >= kth[:, None])
            if not len(who):
                # Bounds only get lower from here.
                break
            block = blocks[who, at]
            by_block = np.argsort(block, kind="stable")
            who, block = who[by_block], block[by_block]
            begin = np.flatnonzero(np.diff(block, prepend=-1))
            found = [held]
            for b, queries in zip(block[begin], np.split(who, begin[1:])):
                score = products(self.forward[b], q[queries])
                scored += score.size
                good = (score >= kth[queries]) & (self.ids[b][:, None] != ask[queries])
                doc, j = np.nonzero(good)
                found.append((queries[j], self.ids[b][doc], score[doc, j]))
            held = tuple(np.concatenate(column) for column in zip(*found))
            keep = best_of(*held, k)
            held = tuple(column[keep] for column in held)
            n = np.bincount(held[0], minlength=len(ask))
            full = np.flatnonzero(n >= k)
            last = np.cumsum(n) - 1
            kth[full] = np.maximum(kth[full], held[2][last[full]])
            start, many = start + many, many * 2
        return *held, scored


def ordered(rows: DataFrame, leaders: np.ndarray) -> DataFrame:
    """Adds ``near``, the leader with the largest inner product."""
    width = leaders.shape[1]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = products(matrix(batch, "x", width), leaders).argmax(axis=1) if batch.num_rows else np.empty(0, int)
            yield batch.append_column("near", pa.array(near.astype(np.int32)))

    return rows.mapInArrow(placed, f"{', '.join(f'{n} {t}' for n, t in rows.dtypes)}, near int")


def blocks_of(rows: DataFrame, width: int, block: int) -> DataFrame:
    """One row for each block of documents in their order; a shard is a partition."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, n = TaskContext.get().partitionId(), 0
        held_ids, held = np.empty(0, np.int64), np.empty((0, width), np.int32)

        def made(ids, x, number):
            high, low = x.max(axis=0), x.min(axis=0)
            values = [[shard], [number], [ids.tobytes()], [x.tobytes()], [high.tobytes()], [low.tobytes()]]
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
            arrays = [pa.array(v, kind) for v, kind in zip(values, kinds)]
            return pa.RecordBatch.from_arrays(arrays, ["shard", "block", "ids", "forward", "high", "low"])

        for batch in batches:
            held_ids = np.concatenate([held_ids, batch.column("vec_id").to_numpy()])
            held = np.concatenate([held, matrix(batch, "x", width, np.int32)])
            whole = len(held) // block * block
            for at in range(0, whole, block):
                yield made(held_ids[at : at + block], held[at : at + block], n)
                n += 1
            held_ids, held = held_ids[whole:], held[whole:]
        if len(held):
            yield made(held_ids, held, n)

    return rows.mapInArrow(cut, "shard int, block int, ids binary, forward binary, high binary, low binary")


def exact_top(
    rows: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` rows of the largest inner product, its own left out.

    Components become ``floor(scale * x)``, scores are whole numbers, ties go to the smaller id. Vectors that are null or
    hold null or non-finite components take no part, nor do rows without an id, nor vectors of another dimension than the
    commonest (the larger of two). Rows with one id are candidates each, but one query, the one with the least vector; none of them is
    its candidate. Queries have fewer rows if there are fewer candidates; no rows give no rows. Components too large for
    exact results in 64 bits are an error (``integers.floored``).
    """
    found = searched(rows, is_query, k, scale, key, vector, block)
    out = "query_id long, rank int, vec_id long, score long"
    if found is None:
        return rows.sparkSession.createDataFrame([], out)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def searched(
    rows: DataFrame, is_query: Column, k: int, scale: int, key: str, vector: str, block: int
) -> DataFrame | None:
    """``query_id, vec_id, score``: the ``k`` best of each query and shard that may be among its ``k`` best of all."""
    spark: SparkSession = rows.sparkSession
    named = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    named = named.filter(F.col("vec_id").isNotNull())
    width = commonest_size(named, "v")
    if width is None:
        return None
    kept = named.filter(sound("v") & (F.size("v") == width)).select("vec_id", "q", floored("v", scale).alias("x"))
    whole = staged(kept, "whole-numbers")
    n, asked = whole.agg(F.count(F.lit(1)), F.count_if("q")).first()
    if not asked:
        return None
    # The hash covers the id, so copies of one vector do not fill the sample.
    sample = whole.orderBy(F.xxhash64("vec_id", "x"), "vec_id", "x").limit(LEADERS).select("x").collect()
    placed = ordered(whole, np.unique(np.array([r["x"] for r in sample], np.int64), axis=0))
    shards = max(-(-n // SHARD_ROWS), min(LEAST_SHARDS, -(-n // LEAST_SHARD_ROWS)))
    dealt = placed.repartitionByRange(shards, "near", "x", "vec_id").sortWithinPartitions("near", "x", "vec_id")
    index = staged(blocks_of(dealt.select("vec_id", "x"), width, block), "blocks")
    shards = index.agg(F.max("shard")).first()[0] + 1

    # A query begins in the shard that has its id; of repeated ids, the least vector asks.
    homes = index.select("shard", "ids").mapInArrow(_ids, "shard int, query_id long").groupBy("query_id").agg(F.min("shard").alias("home"))
    asking = whole.filter("q").groupBy("vec_id").agg(F.min("x").alias("x")).join(homes, F.col("vec_id") == F.col("query_id"))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-asked // QUERY_ROWS)))).cast("int").alias("part")
    queries = staged(asking.select("vec_id", "x", "home", part), "queries")
    parts = queries.agg(F.max("part")).first()[0] + 1

    def every(count: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    search = _search(width, k)
    out = "query_id long, vec_id long, score long"
    home = queries.select("vec_id", "x", F.col("home").alias("shard"), F.lit(NOTHING).alias("floor"))
    first = staged(index.groupBy("shard").cogroup(home.groupBy("shard")).applyInPandas(search, out), "home-results")
    floors = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    floor = F.when(F.col("n") >= k, F.col("least")).otherwise(F.lit(NOTHING)).alias("floor")
    known = queries.join(floors, queries["vec_id"] == floors["query_id"], "left").select("vec_id", "x", "home", "part", floor)
    away = known.select("vec_id", "x", "floor", "part", "home", every(shards, "shard")).filter("shard != home")
    data = index.select("*", every(parts, "part"))
    rest = data.groupBy("shard", "part").cogroup(away.groupBy("shard", "part")).applyInPandas(search, out)
    return first.unionByName(rest)


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of blocks, one row each."""
    for batch in batches:
        for shard, ids in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist()):
            ids = np.frombuffer(ids, np.int64)
            arrays = [pa.array(np.full(len(ids), shard, np.int32)), pa.array(ids)]
            yield pa.RecordBatch.from_arrays(arrays, ["shard", "query_id"])


def _search(width: int, k: int):
    def search(blocks: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = ("query_id", "vec_id", "score")
        if not len(blocks) or not len(queries):
            return pd.DataFrame({name: np.empty(0, np.int64) for name in names})
        shard = Shard(*(list(blocks[c]) for c in ("ids", "forward", "high", "low")), width)
        ask, q = queries["vec_id"].to_numpy(), np.stack(queries["x"].to_list()).astype(np.int64)
        floor, out = queries["floor"].to_numpy(), []
        for at in range(0, len(q), STEP):
            part = slice(at, at + STEP)
            who, ids, score, _ = shard.search(ask[part], q[part], floor[part], k)
            out.append((ask[part][who], ids, score))
        return pd.DataFrame({name: np.concatenate([o[i] for o in out]) for i, name in enumerate(names)})

    return search


def exact_top_sql(every: int = 100, k: int = 10, scale: int = 1024) -> str:
    """The same over ``embeddings`` in SQL, every query compared with every row; queries have ids divisible by ``every``."""
    return f"""
WITH sound AS (
    SELECT vec_id, embedding AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
size AS (SELECT len(v) AS d FROM sound GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1),
kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(v, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM sound JOIN size ON len(v) = d),
asking AS (SELECT vec_id AS query_id, min(v) AS q FROM kept WHERE vec_id % {every} = 0 GROUP BY 1),
point AS (SELECT rid, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM kept),
asked AS (SELECT query_id, unnest(range(1, len(q) + 1)) AS i, unnest(q) AS y FROM asking),
scored AS (SELECT query_id, rid, CAST(sum(x * y) AS BIGINT) AS score FROM asked JOIN point USING (i) GROUP BY 1, 2)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored JOIN kept USING (rid) WHERE vec_id <> query_id) WHERE rank <= {k}
"""
