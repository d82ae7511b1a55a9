"""Scoring a manifest that keeps growing.

Which ids have been delivered is kept by the stream itself, in a state store with one entry for each id: a micro-batch looks up and
writes the ids it brings, and reads no earlier results. So its cost depends on the batch, not on how many there were
before.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from framelark.operators.scoring import Generate, score, scoring_input
from framelark.schemas import BATCH_SIZE, INFERENCE_MANIFEST, RESULT
from framelark.session import staged
from framelark.sources.jsonl import LINE_ORDER, line_columns, parse_strict
from framelark.streaming.merge import checkpoint_token

SCORED_SCHEMA = f"{RESULT}, run string, batch bigint"
PROGRESS_SCHEMA = "run string, batch bigint, processed bigint, errors bigint, seconds double, per_second double"
_RECORD = ["prompt", "image", "images"]
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ON_DISK = {
    _STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A commit uploads what the batch changed, not the whole store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state on disk instead of in memory, unless the session names a store itself.

    A stream takes the session's settings when it starts, so they are put back afterwards.
    """
    before = {key: spark.conf.get(key, None) for key in _ON_DISK}
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    if before[_STORE] not in (None, default):
        yield
        return
    for key, value in _ON_DISK.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """Results written so far, by all checkpoints."""
    return spark.read.schema(SCORED_SCHEMA).parquet(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row for each batch: records processed, errors among them, seconds and records per second."""
    return spark.read.schema(PROGRESS_SCHEMA).json(path)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts the lines a task reads, in reading order; streams have no other expression for it."""
    n = 0
    for batch in batches:
        yield batch.append_column("line", pa.array(range(n, n + batch.num_rows), pa.int64()))
        n += batch.num_rows


def delivered(lines: DataFrame) -> DataFrame:
    """``id, record, first, last`` of every id that a micro-batch brings: the record to score and when the id first came.

    The record is the last one in the order of files and lines of the newest delivery. ``first`` and ``last`` are times of
    micro-batches, which a repeated batch has again: they are equal if the id never came before.
    """
    rows = lines.mapInArrow(_numbered, "raw string, file string, block bigint, line bigint")
    records = parse_strict(rows, INFERENCE_MANIFEST).withColumn("arrival", F.current_timestamp())
    place = F.struct("arrival", *LINE_ORDER)
    return records.filter(F.col("id").isNotNull()).groupBy("id").agg(
        F.max_by(F.struct(*_RECORD), place).alias("record"),
        F.min("arrival").alias("first"),
        F.max("arrival").alias("last"),
    )


def unnamed(lines: DataFrame) -> DataFrame:
    """Records without an id in the columns of ``delivered``."""
    records = parse_strict(lines.select("raw"), INFERENCE_MANIFEST).filter(F.col("id").isNull())
    never = F.lit(None).cast("timestamp")
    return records.select("id", F.struct(*_RECORD).alias("record"), never.alias("first"), never.alias("last"))


def score_manifest_stream(
    spark: SparkSession,
    manifest_path: str,
    results_path: str,
    checkpoint: str,
    model_factory: Callable[[], Generate],
    load_image: Callable[[str], Any],
    model_name: str,
    batch_size: int = BATCH_SIZE,
    files_per_batch: int = 100,
    partitions: int | None = None,
    pattern: str = "*.jsonl",
    retry_errors: bool = False,
    rejects_path: str | None = None,
    progress_path: str | None = None,
) -> StreamingQuery:
    """Score the manifest files present, ``files_per_batch`` at a time; results are committed per micro-batch.

    An id that this checkpoint has delivered before is not scored again: its state store knows. Ids with results of
    other checkpoints are read once, when the stream starts. With ``retry_errors``, ids that come again are scored again if
    none of their results is an answer; only for those does a batch look into earlier results. A batch that is repeated after
    a failure finds the state as it was before it, and replaces its own results: their folder is named by the
    checkpoint's token and the number of the batch, so no other checkpoint's results are touched. Records without an id are
    written to ``rejects_path``, if there is one, and not scored. ``progress_path`` gets a row for each batch, with
    counts taken while the results are written (``read_progress``).

    The state has a record for each id, in as many partitions as ``spark.sql.shuffle.partitions`` says at the first start.
    """
    # The folder has to exist before the first batch reads it.
    spark.createDataFrame([], RESULT).write.mode("overwrite").parquet(f"{results_path}/run=none/batch=-1")
    token = checkpoint_token(spark, checkpoint)
    others = read_scored(spark, results_path).filter(F.col("run") != token)
    others = others.filter(F.col("error").isNull()) if retry_errors else others
    others = staged(others.select("id").distinct(), "other-results")
    has_others = not others.isEmpty()

    def answered(batch_id: int) -> DataFrame:
        done = read_scored(spark, results_path).filter((F.col("run") == token) & (F.col("batch") < batch_id))
        return done.filter(F.col("error").isNull()).select("id").distinct()

    def run(batch: DataFrame, batch_id: int) -> None:
        # Read several times; computed once, as it updates the state.
        rows = batch.persist()
        try:
            if rejects_path is not None:
                rejects = rows.filter(F.col("id").isNull()).select("id", "record.*")
                rejects.write.mode("overwrite").parquet(f"{rejects_path}/run={token}/batch={batch_id}")
            named = rows.filter(F.col("id").isNotNull())
            pending = named.filter(F.col("first") == F.col("last"))
            if retry_errors:
                again = named.filter(F.col("first") < F.col("last"))
                if not again.isEmpty():
                    pending = pending.unionByName(again.join(answered(batch_id), "id", "left_anti"))
            if has_others:
                pending = pending.join(others, "id", "left_anti")
            records = scoring_input(pending.select("id", "record.*"))
            scored = score(records, model_factory, load_image, model_name, batch_size, partitions=partitions)
            seen = Observation(f"batch {batch_id}")
            scored = scored.observe(
                seen, F.count(F.lit(1)).alias("processed"), F.count_if(F.col("error").isNotNull()).alias("errors")
            )
            began = time.monotonic()
            scored.write.mode("overwrite").parquet(f"{results_path}/run={token}/batch={batch_id}")
            seconds = time.monotonic() - began
            if progress_path is not None:
                n, errors = seen.get["processed"], seen.get["errors"]
                row = (n, errors, seconds, n / seconds if seconds > 0 else 0.0)
                kinds = "processed bigint, errors bigint, seconds double, per_second double"
                found = batch.sparkSession.createDataFrame([row], kinds).coalesce(1)
                found.write.mode("overwrite").json(f"{progress_path}/run={token}/batch={batch_id}")
        finally:
            rows.unpersist()

    reader = spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    lines = reader.option("maxFilesPerTrigger", files_per_batch).text(manifest_path).select(*line_columns())
    found = delivered(lines) if rejects_path is None else delivered(lines).unionByName(unnamed(lines))
    with state_on_disk(spark):
        return (
            found.writeStream.foreachBatch(run)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
