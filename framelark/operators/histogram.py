"""Value counts and totals. All combine map-side, so a value held by a third of the rows costs one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.operators.layout import with_running_total


def value_counts(df: DataFrame, column: str | Column, name: str = "value", top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first and then by value; null is a value too."""
    col = F.col(column) if isinstance(column, str) else column
    counts = df.groupBy(col.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), F.asc_nulls_first(name))
    return ordered if top is None else ordered.limit(top)


def shard_counts(df: DataFrame, shard: str = "shard") -> DataFrame:
    """Rows and running total per shard, and one row with a null shard for the whole."""
    counts = df.groupBy(shard).agg(F.count(F.lit(1)).alias("n"))
    running = with_running_total(counts, shard, "n", "running_total")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(
        F.lit(None).cast(counts.schema[shard].dataType).alias(shard), "n", F.col("n").alias("running_total")
    )
    return running.unionByName(total)


def run_throughput(results: DataFrame, run: str, at: str) -> DataFrame:
    """Records, seconds between first and last, and records per second (0 where no time passed) per run."""
    span = F.col("_last") - F.col("_first")
    part = {unit: F.extract(F.lit(unit), span) for unit in ("DAY", "HOUR", "MINUTE", "SECOND")}
    seconds = (
        part["DAY"] * 86400 + part["HOUR"] * 3600 + part["MINUTE"] * 60 + part["SECOND"].cast("double")
    ).cast("double")
    found = results.groupBy(run).agg(
        F.count(F.lit(1)).alias("processed"), F.min(at).alias("_first"), F.max(at).alias("_last")
    )
    found = found.withColumn("elapsed", seconds).drop("_first", "_last")
    return found.withColumn(
        "rate", F.when(F.col("elapsed") > 0, F.col("processed") / F.col("elapsed")).otherwise(F.lit(0.0))
    )
