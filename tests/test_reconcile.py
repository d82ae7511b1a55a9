"""Which shards differ, when counts do not tell."""

import random

import pytest
from pyspark.sql import functions as F
from test_places import paths_above

from framelark.operators.pending import content_digests, differing_shards, reconcile_content

def by_seven():
    return F.pmod("id", F.lit(7))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a string, b int")


def some(n=200, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(["x", "y", None, ""]), rng.choice([1, None])) for i in range(n)]


def found(spark, wanted, made):
    rows = reconcile_content(frame(spark, wanted), frame(spark, made), by_seven(), ["id", "a", "b"]).collect()
    return {r.shard: (r.n_in, r.n_out, r.rows_missing, r.rows_unexpected, r.ids_changed) for r in rows}


def test_equal_contents_in_any_order(spark):
    rows = some()
    shuffled = random.Random(2).sample(rows, len(rows))
    assert found(spark, rows, shuffled) == {} == found(spark, rows + rows[:9], shuffled + rows[:9]) == found(spark, [], [])
    one = content_digests(frame(spark, rows).repartition(5), by_seven(), ["a", "b"]).collect()
    assert sorted(one) == sorted(content_digests(frame(spark, shuffled).coalesce(1), by_seven(), ["a", "b"]).collect())


def test_a_swapped_record_is_found_though_all_counts_are_equal(spark):
    rows = some()
    rows[10], rows[17] = (10, "p", 1), (17, "q", 1)
    swapped = list(rows)
    swapped[10], swapped[17] = (10, "q", 1), (17, "p", 1)
    n = len([r for r in rows if r[0] % 7 == 3])
    assert found(spark, rows, swapped) == {3: (n, n, 2, 2, 2)}


def test_missing_new_changed_and_repeated_rows(spark):
    rows = [(i, "x", 1) for i in range(70)]
    made = [r for r in rows if r[0] not in (7, 14, 8)] + [(71, "x", 1), (9, "x", 1), (9, "x", 1)]
    made = [(i, None if i == 11 else a, b) for i, a, b in made]
    assert found(spark, rows, made) == {0: (10, 8, 2, 0, 0), 1: (10, 10, 1, 1, 0), 2: (10, 12, 0, 2, 0), 4: (10, 10, 1, 1, 1)}
    # A null and an empty text are not the same, nor is a null key left out.
    assert found(spark, [(None, "", 1)], [(None, None, 1)]) == {None: (1, 1, 1, 1, 0)}
    assert found(spark, rows, []) == {s: (10, 0, 10, 0, 0) for s in range(7)}


def test_rows_of_equal_shards_are_not_shuffled(spark, tmp_path):
    rows = some()
    frame(spark, rows).write.parquet(str(tmp_path / "a"))
    frame(spark, [(i, "z" if i == 3 else a, b) for i, a, b in rows]).write.parquet(str(tmp_path / "b"))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    result = reconcile_content(a, b, by_seven(), ["id", "a", "b"])
    assert result.count() == 1
    for path in paths_above(result, "a"):
        # From the scan up, the first exchange comes after the rows of equal shards are gone, or after one row per shard is left.
        shuffles = [i for i, kind in enumerate(path) if kind == "ShuffleExchangeExec"]
        below = path[max(shuffles) :]
        assert "BroadcastHashJoinExec" in below or "HashAggregateExec" in below
    assert differing_shards(a, b, by_seven(), ["id", "a", "b"]).collect()[0].shard == 3
    with pytest.raises(Exception):
        content_digests(a, by_seven(), ["no such"]).collect()
