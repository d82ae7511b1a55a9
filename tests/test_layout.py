"""Row numbers, previous rows and running totals over few and many partitions; sharding and chunks."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from framelark.operators import sharding
from framelark.operators.layout import with_previous, with_row_index, with_running_total


@pytest.fixture
def skewed(spark):
    """A thousand rows in mixed order; one group holds most of them and null is a group."""
    n = F.col("id")
    group = F.when(n % 10 < 7, "hot").when(n % 10 == 7, F.lit(None)).otherwise(F.concat(F.lit("g"), (n % 50).cast("string")))
    return spark.range(1000).select((n * 7919 % 1000).alias("v"), group.alias("g")).repartition(7)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_row_index_is_the_place_in_order(spark, skewed):
    rows = with_row_index(skewed, ["v"])
    assert rows.count() == 1000 and rows.filter("v != row_index").isEmpty()
    down = with_row_index(skewed, [F.desc("v")])
    assert down.filter("v + row_index != 999").isEmpty()


def test_row_index_within_groups_splits_large_ones(skewed):
    plain = with_row_index(skewed, ["v"], ["g"])
    assert plain.count() == 1000
    hot = plain.filter("g = 'hot'")
    assert hot.filter("row_index = 0").count() == 1 and hot.agg(F.max("row_index")).first()[0] == hot.count() - 1
    for parts in (1, 3, 40):
        assert same(plain, with_row_index(skewed, ["v"], ["g"], parts=parts))


def test_previous_row_splits_large_groups(skewed):
    plain = with_previous(skewed, ["g"], ["v"], {"before": "v"})
    assert plain.filter("before IS NULL").count() == skewed.select("g").distinct().count()
    w = Window.partitionBy("g").orderBy("v")
    assert same(plain, skewed.withColumn("before", F.lag("v").over(w)))
    for parts in (1, 3, 40, 900):
        assert same(plain, with_previous(skewed, ["g"], ["v"], {"before": "v"}, parts=parts))


def test_row_index_of_nothing(spark, skewed):
    assert with_row_index(skewed.limit(0), ["v"]).isEmpty()
    assert with_row_index(skewed.limit(0), ["v"], ["g"]).isEmpty()


def test_running_total_over_blocks(spark):
    counts = spark.range(100).select((F.col("id") * 3).alias("shard"), (F.col("id") % 5 + 1).alias("n"))
    rows = with_running_total(counts, "shard", "n", "total", block=16).orderBy("shard").collect()
    total = 0
    for row in rows:
        total += row.n
        assert row.total == total


@pytest.mark.parametrize("n", range(1, 9))
def test_shards_are_disjoint_and_complete(spark, n):
    records = spark.range(23).withColumnRenamed("id", "i")
    dealt = {(r.i, r.shard) for r in sharding.interleaved(records, ["i"], n).collect()}
    assert dealt == {(i, i % n) for i in range(23)}


def test_one_shard_and_its_base(spark):
    records = spark.range(10).withColumnRenamed("id", "i")
    assert [r.i for r in sharding.one_shard(records, ["i"], 1, 3).orderBy("i").collect()] == [1, 4, 7]
    # Counting from one, the first line belongs to shard 1.
    assert [r.i for r in sharding.one_shard(records, ["i"], 1, 3, base=1).orderBy("i").collect()] == [0, 3, 6, 9]
    with pytest.raises(ValueError):
        sharding.one_shard(records, ["i"], 3, 3)
    with pytest.raises(ValueError):
        sharding.interleaved(records, ["i"], 0)


def test_hashed_shards_stay_put_when_records_are_added(spark):
    few = {(r.id, r.shard) for r in sharding.hashed(spark.range(50), "id", 4).collect()}
    more = {(r.id, r.shard) for r in sharding.hashed(spark.range(80), "id", 4).collect()}
    assert few < more and {s for _, s in more} == {0, 1, 2, 3}


def test_chunks_are_full_but_for_the_last(spark):
    chunks = sharding.chunked(spark.range(500), ["id"]).groupBy("chunk").count().orderBy("chunk").collect()
    assert [r["count"] for r in chunks] == [48] * 10 + [20]


def test_looking_back_shuffles_once(spark):
    rows = spark.range(3000).select((F.col("id") % 7).cast("string").alias("k"), F.col("id").alias("at"), F.lit("x").alias("v"))
    found = with_previous(rows, ["k"], ["at"], {"before": "v"}, parts=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    # That one is of the last rows of the partitions.
    assert "partial_max_by" in plan.split("Exchange hashpartitioning")[1]


def test_looking_back_with_null_and_several_keys(spark):
    rows = [(None, 1, 1, "a"), (None, 1, 2, None), (None, None, 3, "c"), (None, None, 4, "d"), ("x", None, 1, "e"), ("x", 1, 1, "f")]
    df = spark.createDataFrame(rows, "k string, j int, at int, v string")
    for parts in (1, 2, 6, None):
        found = with_previous(df, ["k", "j"], ["at"], {"before": "v", "when": "at"}, parts=parts)
        assert {(r.k, r.j, r.at): (r.before, r.when) for r in found.collect()} == {
            (None, 1, 1): (None, None), (None, 1, 2): ("a", 1), (None, None, 3): (None, None), (None, None, 4): ("c", 3),
            ("x", None, 1): (None, None), ("x", 1, 1): (None, None),
        }
