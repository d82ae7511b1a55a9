"""Result shards that keep arriving, merged on read.

Each micro-batch is written to a folder of its own, named by the checkpoint's token and the batch, and replaces what an
earlier attempt of that batch left there. So a restart neither loses nor doubles lines, and another checkpoint writes
beside what is there, never over it. The merge is last-wins in file and line order, which makes it the same whatever way
the files were cut into batches.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from framelark.plans.results import classified
from framelark.sources.jsonl import LINE_ORDER, line_columns, numbered_lines

PLACE = "struct<file: string, block: bigint, line: bigint>"
#: The last two columns are there in compacted logs.
LOG_SCHEMA = (
    "raw string, file string, block bigint, line bigint, id string, is_error boolean, "
    f"first_seen {PLACE}, n_records bigint, run string, batch bigint"
)


def checkpoint_token(spark: SparkSession, checkpoint: str) -> str:
    """A name for all batches of one checkpoint, made when it is first used and kept beside it.

    Whatever a crash left of an earlier attempt, the first token that was written whole counts from then on.
    """
    path = f"{checkpoint}/run_token"

    def written(tokens: list[tuple[str]]) -> str | None:
        spark.createDataFrame(tokens, "token string").coalesce(1).write.mode("append").json(path)
        return spark.read.schema("token string").json(path).agg(F.min("token")).first()[0]

    # Nothing is appended first, so that there is a folder to read.
    return written([]) or written([(uuid.uuid4().hex,)])


def stream_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl", files_per_batch: int = 1000) -> DataFrame:
    """Lines of the files below ``path`` as a stream, with their file and split."""
    reader = spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return reader.option("maxFilesPerTrigger", files_per_batch).text(path).select(*line_columns())


def append_log(lines: DataFrame, log_path: str, checkpoint: str) -> StreamingQuery:
    """Write the classified lines of all files present, then stop; started again, it goes on with new files.

    A new checkpoint on an old log delivers the files again; the merge keeps the same lines, but counts both deliveries.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = classified(numbered_lines(batch)).drop("fields")
        rows.write.mode("overwrite").parquet(f"{log_path}/run={token}/batch={batch_id}")

    token = checkpoint_token(lines.sparkSession, checkpoint)
    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _read_log(spark: SparkSession, log_paths: tuple[str, ...]) -> DataFrame:
    from framelark.streaming.tiers import live_runs, read_live

    def read(path: str) -> DataFrame:
        version, _ = live_runs(spark, path)
        if version:
            return read_live(spark, path).drop("bucket")
        return spark.read.schema(LOG_SCHEMA).parquet(path).drop("run", "batch")

    return reduce(DataFrame.unionByName, [read(path) for path in log_paths])


def merged_rows(log: DataFrame) -> DataFrame:
    """``results.merged`` for logs whose rows may stand for several lines already."""
    place = F.struct(*LINE_ORDER).cast(PLACE)
    return log.filter(~F.col("is_error") & F.col("id").isNotNull()).groupBy("id").agg(
        F.max_by("raw", place).alias("raw"),
        F.min(F.coalesce("first_seen", place)).alias("first_seen"),
        F.max(place).alias("last_seen"),
        F.sum(F.coalesce("n_records", F.lit(1))).alias("n_records"),
    )


def unmerged_rows(log: DataFrame) -> DataFrame:
    """The lines a merge keeps as they are: errors and lines without an id."""
    return log.filter(F.col("is_error") | F.col("id").isNull())


def merged_log(spark: SparkSession, *log_paths: str) -> DataFrame:
    """Train records of everything logged so far, in one log or several (such as a compacted one and its successor)."""
    return merged_rows(_read_log(spark, log_paths))


def compact_log(spark: SparkSession, path: str, *log_paths: str) -> None:
    """Write a log that holds, of every id, the last ok line, and all error lines.

    Merging it gives the same records, first places and numbers of lines included, so it stands in for ``log_paths``. It
    cannot be written over one of them. All of the log is rewritten; ``tiers.compact_tiers`` is for logs that keep growing.
    """
    if path.rstrip("/") in [p.rstrip("/") for p in log_paths]:
        raise ValueError(f"{path} is read and cannot be written over")
    log = _read_log(spark, log_paths)
    last = merged_rows(log).select("raw", "last_seen.*", "id", F.lit(False).alias("is_error"), "first_seen", "n_records")
    rest = unmerged_rows(log).select(*last.columns)
    last.unionByName(rest).write.mode("overwrite").parquet(f"{path}/run=compacted/batch=0")
