"""Which rows of the media are wanted, told to them by bit maps."""

import random

import pytest
from pyspark.sql import functions as F

from framelark.operators.places import CONTAINER, bits_before, has_bit
from framelark.plans import ingest


def above(node, wanted, path=()):
    """The names of the plan's nodes above the scan that reads the wanted column."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return above(node.initialPlan(), wanted, path)
    children = node.children()
    if children.isEmpty():
        return [path] if f"{wanted}#" in node.output().toString() else []
    found = []
    for i in range(children.size()):
        found += above(children.apply(i), wanted, (*path, kind))
    return found


def paths_above(df, wanted):
    return above(df._jdf.queryExecution().executedPlan(), wanted)


def test_bits(spark):
    rng = random.Random(2)
    bits = sorted(rng.sample(range(CONTAINER), 500)) + [CONTAINER - 1]
    made = spark.createDataFrame([(b,) for b in bits], "b int").agg(F.bitmap_construct_agg("b").alias("all"))
    asked = spark.createDataFrame([(b,) for b in {*bits, *range(0, CONTAINER, 97), 0, 1, 7, 8}], "b int")
    # Bytes that are cut off count as zeros, and no bit map has no bits.
    cut = asked.crossJoin(made).select(
        "b", "all", F.substring("all", 1, 2000).alias("front"), F.lit(None).cast("binary").alias("none")
    )
    shown = cut.select("b", *[f(F.col(c), F.col("b")).alias(f"{f.__name__}_{c}") for f in (has_bit, bits_before) for c in ("all", "front")], has_bit(F.col("none"), F.col("b")).alias("n"))
    for r in shown.collect():
        assert r.has_bit_all == (r.b in bits) and r.bits_before_all == len({b for b in bits if b < r.b})
        assert r.has_bit_front == (r.b in bits and r.b < 16_000) and r.n is False
        assert r.bits_before_front == len({b for b in bits if b < min(r.b, 16_000)})


def shard_frame(spark, rows):
    """(shard, row_pos, category, file name) as source rows; the bytes name the place."""
    meta = "struct<content_parent_category: string, content_fine_category: string, original_video_filename: string, youtube_channel: string, youtube_title: string, youtube_upload_date: string, duration_seconds: bigint, resolution: string>"
    df = spark.createDataFrame(rows, "shard int, row_pos long, category string, name string")
    given = {"content_parent_category": F.col("category"), "original_video_filename": F.col("name")}
    fields = [given.get(f, F.lit(None)).alias(f) for f in [p.split(":")[0] for p in meta[7:-1].split(", ")]]
    place = F.concat_ws("/", "shard", "row_pos").cast("binary")
    return df.select("shard", "row_pos", place.alias("mp4"), F.struct(*fields).cast(meta).alias("json"))


def odd_shards():
    """Shards longer than a container, with repeated, missing and unusable names; rows of other categories between them."""
    rng, rows = random.Random(4), []
    for shard, n in ((0, 2 * CONTAINER + 77), (1, 40), (3, 0), (4, CONTAINER), (5, 3)):
        for pos in range(n):
            category = rng.choice(["a", "a", "b", None])
            name = rng.choice([None, "x/", f"v/{shard}_{pos}.mp4", f"{rng.randrange(30)}.mp4"]) if pos % 9 == 0 else f"{shard}_{pos}.mp4"
            rows.append((shard, pos, category, name))
    return rows


def test_media_of_every_manifest_entry_and_no_other(spark):
    shards = shard_frame(spark, odd_shards()).repartition(5).cache()
    stored = shards.filter("row_pos % 5 = 1").selectExpr("concat(shard, '_', row_pos) as video_id")
    done = spark.createDataFrame([(4,)], "shard int")
    for options in ({}, {"ingested": stored}, {"done_shards": done}, {"ingested": stored, "done_shards": done}):
        entries = ingest.build_manifest(shards, "a", "p", **options).cache()
        found = ingest.media_rows(shards, entries, "a")
        assert found.columns == [*shards.columns, "video_id"]
        shown = found.select("video_id", "shard", "row_pos", F.col("mp4").cast("string").alias("place"))
        expected = entries.select("video_id", "shard", "row_pos", F.concat_ws("/", "shard", "row_pos").alias("place"))
        assert shown.exceptAll(expected).isEmpty() and expected.exceptAll(shown).isEmpty()
        assert shown.count() > 20_000
    assert ingest.media_rows(shards, entries.limit(0), "a").isEmpty()
    assert ingest.media_rows(shards, entries, "no such").isEmpty()


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_media_are_not_exchanged(spark, tmp_path, threshold):
    shard_frame(spark, odd_shards()[:100]).write.parquet(str(tmp_path / "shards"))
    shards = spark.read.parquet(str(tmp_path / "shards"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = ingest.media_rows(shards, ingest.build_manifest(shards, "a", "p"), "a")
        (path,) = paths_above(found, "mp4")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoinExec" in path
    assert not [kind for kind in path if "Exchange" in kind or "Sort" in kind or "Window" in kind]


def test_containers_say_no_more_than_needed(spark):
    rows = [(0, p, "a", f"{p}.mp4") for p in range(100)] + [(1, p, "a", f"o{p}.mp4") for p in range(50)]
    shards = shard_frame(spark, rows).cache()
    entries = ingest.build_manifest(shards, "a", "p")
    from framelark.operators.places import row_containers

    places, never = shards.select("shard", "row_pos"), F.lit(False)
    assert row_containers(places, entries, never).isEmpty()
    (some,) = row_containers(places, entries.filter("not (shard = 0 and row_pos in (3, 10))"), never).collect()
    assert (some.shard, some.none, bytes(some.lost), some.members) == (0, False, bytes([8, 4]), None)
    whole = row_containers(places, entries.filter("shard = 1"), never).collect()
    assert [(r.shard, r.none, r.lost) for r in whole] == [(0, True, None)]
