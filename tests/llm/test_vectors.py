"""Clusters, vector codes and exact search: against plain loops, and against their SQL on tables with every odd row."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from framelark.llm import blockmax
from framelark.llm.blockmax import Shard, exact_top, exact_top_sql
from framelark.llm.clustering import clusters, clusters_sql, nearest_centroid, spread_out, to_points
from framelark.llm.vectorcodes import Book, compressed, compressed_sql
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, x string, v string, code string, cluster string, shard string, salt int"


def odd_rows(width=64):
    nan, inf, one = float("nan"), float("inf"), [0.5] * width
    return [
        (9001, None, 1), (9002, [], 1), (9003, [0.5] * (width - 1) + [None], 1), (9004, [nan] + one[1:], 2),
        (9100, [inf] + one[1:], 2), (9200, [-inf] + one[1:], 2), (9300, [0.0] * width, None), (9400, one, None),
        (9400, one, None), (9400, [-0.25] * width, 3), (None, one, 3), (None, [0.125] * width, None),
        (9500, [0.5] * (width * 2), 4), (9600, [0.25] * 3, 4), (7, one, 5), (-100, [-0.5] * width, 5), (-3, [0.001] * width, 5),
    ]


def some_rows(n=260, width=64, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(12, width))
    x = middle[rng.integers(0, 12, n)] * 0.3 + rng.normal(size=(n, width)) * 0.05
    x[n // 2 : n // 2 + 40] = x[0]
    return [(i * 5, [float(np.float32(c)) for c in row], i % 4) for i, row in enumerate(x)] + odd_rows(width)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e", 1) for r in rows], SCHEMA)


def by_sql(rows, sql):
    kinds = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])
    embeddings = pa.Table.from_pylist([dict(zip(kinds.names, r)) for r in rows], schema=kinds)
    con = duckdb.connect()
    con.register("embeddings", embeddings)
    found = con.sql(sql)
    return found.columns, sorted(found.fetchall(), key=repr)


def same(ours, theirs):
    columns, expected = theirs
    assert sorted(ours.columns) == sorted(columns)
    assert sorted((tuple(r) for r in ours.select(*columns).collect()), key=repr) == expected
    assert expected


@pytest.mark.parametrize("parts", [1, 7])
def test_operators_equal_their_sql_on_odd_rows(spark, parts):
    rows = some_rows()
    df = frame(spark, rows).repartition(parts)
    same(clusters(df).drop("compared"), by_sql(rows, clusters_sql()))
    same(compressed(df), by_sql(rows, compressed_sql()))
    same(exact_top(df, F.col("vec_id") % 100 == 0), by_sql(rows, exact_top_sql()))


def test_few_and_no_vectors(spark):
    for rows in (odd_rows(), odd_rows()[7:8], odd_rows()[:6], []):
        df = frame(spark, rows)
        for found, sql in (
            (clusters(df).drop("compared"), clusters_sql()),
            (compressed(df), compressed_sql()),
            (exact_top(df, F.col("vec_id") % 100 == 0), exact_top_sql()),
        ):
            columns, expected = by_sql(rows, sql)
            assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == expected


def test_reruns_agree_whatever_the_partitions(spark):
    df = frame(spark, some_rows(90))
    for run in (clusters, compressed, lambda d: exact_top(d, F.col("vec_id") % 20 == 0)):
        assert sorted(run(df.repartition(5)).collect(), key=repr) == sorted(run(df.coalesce(1)).collect(), key=repr)


def test_too_large_components_are_an_error(spark):
    df = frame(spark, [(1, [1e30] * 64, 1), (2, [0.5] * 64, 1)])
    for run in (clusters, compressed, lambda d: exact_top(d, F.col("vec_id") % 2 == 0)):
        with pytest.raises(Exception, match="too large for exact results"):
            run(df).collect()


def test_large_whole_numbers_stay_exact():
    rng = np.random.default_rng(3)
    x, q = rng.integers(-(2**26), 2**26, (50, 64)), rng.integers(-(2**26), 2**26, (9, 64))
    exact = np.array([[sum(int(a) * int(b) for a, b in zip(r, s)) for s in q] for r in x])
    assert (blockmax.products(x, q) == exact).all() and (blockmax.products(x % 99, q % 99) == (x % 99) @ (q % 99).T).all()


def test_pivots_rule_out_centroids_and_lose_none():
    rng = np.random.default_rng(5)
    middle = rng.integers(-200, 200, (40, 8))
    x = middle[rng.integers(0, 40, 3000)] + rng.integers(-6, 7, (3000, 8))
    centres = np.concatenate([middle, middle[:3]])
    pivots = spread_out(middle, 16)
    assert len(np.unique(pivots, axis=0)) == 16
    label, best, compared = nearest_centroid(x, to_points(x, pivots), centres, pivots)
    every = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (label == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert 1 <= compared.mean() < 5
    # Vectors without any structure, many of them tied.
    x, centres = rng.integers(-1, 2, (2000, 6)), rng.integers(-1, 2, (40, 6))
    pivots = spread_out(centres, 4)
    label, best, _ = nearest_centroid(x, to_points(x, pivots), centres, pivots)
    every = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (label == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()


@pytest.mark.parametrize("n, width, spread", [(64, 4, 300), (64, 4, 2), (256, 3, 40), (65, 2, 3), (1, 4, 9), (5, 1, 1)])
def test_masks_hold_every_entry_that_can_win(n, width, spread):
    rng = np.random.default_rng(n * spread)
    entries, x = rng.integers(-spread, spread + 1, (n, width)), rng.integers(-2 * spread, 2 * spread + 1, (1500, width))
    book = Book(entries)
    every = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    entry, best = book.nearest(x)
    assert (entry == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    masks = np.unpackbits(book.candidates(x).astype("<u8").view(np.uint8).reshape(len(x), -1), axis=1, bitorder="little")
    assert ((every == every.min(axis=1)[:, None]) <= masks[:, :n]).all()
    if (n, spread) == (64, 300):
        assert masks.sum() < 0.3 * len(x) * n


def shard_of(x, ids, block=16):
    cut = [slice(at, at + block) for at in range(0, len(x), block)]
    parts = [x[c].astype(np.int32) for c in cut]
    return Shard(
        [ids[c].tobytes() for c in cut], [p.tobytes() for p in parts], [p.max(0).tobytes() for p in parts],
        [p.min(0).tobytes() for p in parts], x.shape[1],
    )


@pytest.mark.parametrize("clustered", [True, False])
def test_blocks_are_left_out_only_below_the_kth_score(clustered):
    rng = np.random.default_rng(8)
    if clustered:
        middle = rng.normal(size=(20, 32)) * 300
        x = np.repeat(middle, 64, axis=0) + rng.normal(size=(1280, 32)) * 20
        x = x.astype(np.int64)
    else:
        x = rng.integers(-2, 3, (700, 8))
    ids = np.arange(len(x)) * 3
    shard, asked = shard_of(x, ids), np.arange(0, len(x), 50)
    floor = np.full(len(asked), blockmax.NOTHING)
    who, found, score, scored = shard.search(ids[asked], x[asked], floor, 10)
    exact = x @ x[asked].T
    for j, place in enumerate(asked):
        order = sorted((i for i in range(len(x)) if i != place), key=lambda i: (-exact[i, j], ids[i]))[:10]
        assert list(found[who == j]) == [ids[i] for i in order] and list(score[who == j]) == [exact[i, j] for i in order]
        floor[j] = exact[order[9], j]
    if clustered:
        assert scored < 0.2 * len(x) * len(asked)
    # With the k-th score known beforehand, the same documents are found.
    again = shard.search(ids[asked], x[asked], floor, 10)
    assert all((a == b).all() for a, b in zip(again[:3], (who, found, score))) and again[3] <= scored
