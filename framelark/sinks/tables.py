"""Writers. Spark's commit protocol makes each of them all-or-nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelark.operators.dedup import last_per_key
from framelark.plans.results import errors, in_output_order, merged
from framelark.session import staged


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line. Null fields are written, as ``null``."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """A one-row summary as one small object."""
    write_jsonl(summary.coalesce(1), path)


def write_media(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Media bytes and the metadata as JSON text, one row per video, in place of two small objects per video."""
    rows.select("video_id", "mp4", F.to_json("json", {"ignoreNullFields": "false"}).alias("metadata")).write.mode(
        mode
    ).parquet(path)


def export_objects(df: DataFrame, key: str, content: str, put: Callable[[str, bytes], None]) -> None:
    """Hand each row to ``put(key, bytes)`` on the executors, for consumers that want one object per video.

    A retried task puts the same bytes under the same keys again.
    """

    def send(rows):
        for row in rows:
            put(row[0], bytes(row[1]))

    df.select(key, F.col(content).cast("binary")).foreachPartition(send)


def write_shard_log(results: DataFrame, path: str) -> None:
    """Append result records to the log, one folder per shard."""
    results.write.mode("append").option("ignoreNullFields", "true").partitionBy("shard").json(path)


def write_single_results(results: DataFrame, path: str) -> None:
    """Append results, one folder per run.

    Few runs exist (a run is a prompt, a model and a sampling), so this makes few folders; one folder per
    video would make as many as there are videos. A repeated run adds rows, and ``current_results`` reads the newest.
    """
    results.write.mode("append").partitionBy("run_id").parquet(path)


def current_results(spark: SparkSession, path: str) -> DataFrame:
    """Newest result of each video and run: a repeated run replaces, a new prompt adds."""
    found = spark.read.parquet(path).schema
    # Folder names are given their type here: a run named 0042 or 77e1 would be taken for a number.
    schema = T.StructType([T.StructField("run_id", T.StringType()) if f.name == "run_id" else f for f in found])
    stored = spark.read.schema(schema).parquet(path)
    return last_per_key(stored, ["video_id", "run_id"], ["created_at", "answer"])


def write_frames(frames: DataFrame, path: str) -> None:
    frames.select(F.to_json(F.struct(*frames.columns)).alias("value")).write.mode("overwrite").text(path)


def write_merge(log: DataFrame, order_by: list[str], path: str) -> None:
    """The merged train records, in the order their ids were first seen, and all error records, as raw lines.

    The classified log is parsed once and stored, and both are made from that. Both are replaced, so no stale errors are
    left behind.
    """
    log = staged(log.select("raw", "id", "is_error", *order_by), "log")
    in_output_order(merged(log, order_by)).select("raw").write.mode("overwrite").text(f"{path}/train.jsonl")
    errors(log).orderBy(*order_by).select("raw").write.mode("overwrite").text(f"{path}/errors.jsonl")


def mark_done(shards: DataFrame, path: str) -> None:
    """Add shards, one row each, to the table of those that need not be read again."""
    shards.select("shard").distinct().write.mode("append").parquet(path)
