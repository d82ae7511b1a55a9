"""What is left to do: anti-joins against what is done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.operators.dedup import last_per_key


def done_ids(log: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Distinct ids of a classified result log. An error counts as done unless errors are to be retried."""
    finished = log.filter(~F.col("is_error")) if retry_errors else log
    return finished.filter(F.col("id").isNotNull()).select("id").distinct()


def resume_pending(
    manifest: DataFrame,
    log: DataFrame,
    order_by: list[str | Column] | None = None,
    retry_errors: bool = False,
) -> DataFrame:
    """Manifest records without a result yet. Records without an id are in ``rejected_records``.

    With ``order_by``, records sharing an id are first reduced to the last of them; that also leaves unique keys
    on both sides of the join, which then needs no further shuffle.
    """
    named = manifest.filter(F.col("id").isNotNull())
    wanted = last_per_key(named, ["id"], order_by) if order_by else named
    return wanted.join(done_ids(log, retry_errors), "id", "left_anti")


def rejected_records(manifest: DataFrame) -> DataFrame:
    """Manifest records without an id, all of them: a result could not be told to be theirs."""
    return manifest.filter(F.col("id").isNull())


def shards_left(shards: DataFrame, done_shards: DataFrame) -> DataFrame:
    """Rows of a table of shard files (``sources.shard_table``) that are not marked done.

    Anti-joined before any file is opened: a scan of what is left neither lists nor reads the others.
    """
    return shards.join(done_shards.select("shard").distinct(), "shard", "left_anti")


def ingest_pending(
    candidates: DataFrame, ingested: DataFrame | None = None, done_shards: DataFrame | None = None
) -> DataFrame:
    """Candidates whose shard is not marked done and whose video is not stored yet."""
    left = candidates
    if done_shards is not None:
        left = left.join(done_shards.select("shard").distinct(), "shard", "left_anti")
    if ingested is not None:
        left = left.join(ingested.select("video_id").distinct(), "video_id", "left_anti")
    return left


def cache_pending(requested: DataFrame, cached: DataFrame) -> DataFrame:
    """Requested labels whose full key is new, and whether their frames can be reused.

    Both frames carry ``cache_key`` (everything that shapes the answer) and ``frames_key`` (only what shapes the
    frames). Frames are reusable when any cached result used them.
    """
    fresh = requested.join(cached.select("cache_key").distinct(), "cache_key", "left_anti")
    frames = cached.select("frames_key").distinct().withColumn("_have", F.lit(True))
    found = fresh.join(frames, "frames_key", "left")
    return found.withColumn("frames_cached", F.coalesce("_have", F.lit(False))).drop("_have")


def reconcile_counts(wanted: DataFrame, made: DataFrame, key: str = "id") -> DataFrame:
    """Record counts on both sides, how many ids only one of them has, and how many records have no id.

    Each side is counted per id first, so the full join meets unique keys. A null id is neither missing nor unexpected.
    """
    left = wanted.groupBy(F.col(key).alias("_wanted")).agg(F.count(F.lit(1)).alias("_in"))
    right = made.groupBy(F.col(key).alias("_made")).agg(F.count(F.lit(1)).alias("_out"))
    both = left.join(right, F.col("_wanted").eqNullSafe(F.col("_made")), "full").select(
        F.coalesce("_wanted", "_made").isNotNull().alias("_named"), "_in", "_out"
    )
    named = F.col("_named")
    return both.agg(
        F.coalesce(F.sum("_in"), F.lit(0)).alias("n_in"),
        F.coalesce(F.sum("_out"), F.lit(0)).alias("n_out"),
        F.count_if(named & F.col("_out").isNull()).alias("ids_missing"),
        F.count_if(named & F.col("_in").isNull()).alias("ids_unexpected"),
        F.count_if(named & F.col("_in").isNotNull() & F.col("_out").isNotNull()).alias("ids_matched"),
        F.coalesce(F.sum(F.when(~named, F.col("_in"))), F.lit(0)).alias("n_in_without_id"),
        F.coalesce(F.sum(F.when(~named, F.col("_out"))), F.lit(0)).alias("n_out_without_id"),
    )


def content_digests(rows: DataFrame, shard: Column, columns: list[str]) -> DataFrame:
    """``shard, n, high, low``: for each shard, the number of rows and the sum of their 128-bit hashes.

    The sums do not depend on the order of rows, and count repeated ones: two shards have the same digest if they have the same rows
    as often (others with a chance of about 2^-64). One number per shard and task is shuffled.
    """
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    digest = F.md5(text.cast("binary"))

    def half(start: int) -> Column:
        return F.conv(F.substring(digest, start, 16), 16, 10).cast("decimal(20,0)")

    hashed = rows.select(shard.alias("shard"), half(1).alias("_high"), half(17).alias("_low"))
    return hashed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("_high").alias("high"), F.sum("_low").alias("low"))


def differing_shards(wanted: DataFrame, made: DataFrame, shard: Column, columns: list[str]) -> DataFrame:
    """``shard, n_in, n_out`` of the shards whose contents are not the same on both sides, counts equal or not."""
    left = content_digests(wanted, shard, columns).select("shard", F.struct("n", "high", "low").alias("_in"))
    right = content_digests(made, shard, columns).select(F.col("shard").alias("_shard"), F.struct("n", "high", "low").alias("_out"))
    both = left.join(right, F.col("shard").eqNullSafe(F.col("_shard")), "full")
    found = both.filter(~F.col("_in").eqNullSafe(F.col("_out")))
    return found.select(
        F.coalesce("shard", "_shard").alias("shard"),
        F.coalesce("_in.n", F.lit(0)).cast("bigint").alias("n_in"),
        F.coalesce("_out.n", F.lit(0)).cast("bigint").alias("n_out"),
    )


def reconcile_content(
    wanted: DataFrame, made: DataFrame, shard: Column, columns: list[str], key: str = "id"
) -> DataFrame:
    """What differs in each differing shard: ``shard, n_in, n_out, rows_missing, rows_unexpected, ids_changed``.

    Shards are compared by digests first, and rows only of those that differ: the others are read a second time but never
    shuffled. A row is missing if ``wanted`` has it more often than ``made``, by the number of times; it is unexpected the other
    way round. An id is changed if it has rows of both kinds. Rows without an id are compared too; they change no id.

    There is one row for each differing shard, so choose shards, such as the hash of the id modulo some thousands, of
    which there are far fewer than rows.
    """
    differing = differing_shards(wanted, made, shard, columns)
    listed = differing.select(F.col("shard").alias("_shard"))
    names = list(dict.fromkeys([key, *columns]))

    def inside(rows: DataFrame, sign: int) -> DataFrame:
        placed = rows.select(shard.alias("_in_shard"), *names)
        kept = placed.join(F.broadcast(listed), F.col("_in_shard").eqNullSafe(F.col("_shard")), "left_semi")
        return kept.withColumn("_sign", F.lit(sign))

    rows = inside(wanted, 1).unionByName(inside(made, -1))
    surplus = rows.groupBy("_in_shard", *names).agg(F.sum("_sign").alias("_d")).filter("_d != 0")
    per_id = surplus.groupBy("_in_shard", key).agg(
        F.sum(F.greatest("_d", F.lit(0))).alias("_missing"), F.sum(F.greatest(-F.col("_d"), F.lit(0))).alias("_unexpected")
    )
    changed = F.col(key).isNotNull() & (F.col("_missing") > 0) & (F.col("_unexpected") > 0)
    found = per_id.groupBy("_in_shard").agg(
        F.sum("_missing").alias("rows_missing"),
        F.sum("_unexpected").alias("rows_unexpected"),
        F.count_if(changed).alias("ids_changed"),
    )
    return differing.join(found, F.col("shard").eqNullSafe(F.col("_in_shard"))).drop("_in_shard")
