"""Result logs: reading them as a union of shapes, and merging them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelark.functions import run_id
from framelark.operators.dedup import last_with_first_seen
from framelark.schemas import RESULT
from framelark.sources.jsonl import with_fields


def classified(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """Well-formed lines with their id, their fields, and whether they are errors.

    A line is an error if it has the key ``error``, whatever its value. The raw text stays, and with it any fields
    that are not known here.
    """
    return with_fields(lines, raw).withColumns(
        {"id": F.col("fields")["id"], "is_error": F.map_contains_key("fields", "error")}
    )


def parsed(log: DataFrame, raw: str = "raw") -> DataFrame:
    """Known fields of a log as columns."""
    rest = [c for c in log.columns if c not in (raw, "fields", "id")]
    known = {f.name: F.col("fields")[f.name] for f in T.StructType.fromDDL(RESULT).fields}
    known["images"] = F.from_json(known["images"], "array<string>")
    return log.select(*rest, *[c.alias(name) for name, c in known.items()])


def merged(log: DataFrame, order_by: list[str]) -> DataFrame:
    """Train records: per id the last ok line, with the place the id was first seen.

    Lines without an id are not merged into one record; they are in ``rejected``.
    """
    ok = log.filter(~F.col("is_error") & F.col("id").isNotNull())
    return last_with_first_seen(ok, "id", order_by, "raw")


def errors(log: DataFrame, unresolved_only: bool = False) -> DataFrame:
    """Error lines, all of them; or only those whose id has no ok line."""
    failed = log.filter("is_error")
    if not unresolved_only:
        return failed
    solved = log.filter(~F.col("is_error") & F.col("id").isNotNull()).select("id").distinct()
    return failed.join(solved, "id", "left_anti")


def rejected(log: DataFrame) -> DataFrame:
    """Ok lines without an id."""
    return log.filter(~F.col("is_error") & F.col("id").isNull())


def counts(log: DataFrame, file: str = "file", n_files: int | None = None) -> DataFrame:
    """One row: shard files, ids with an ok line, error lines, ok lines without an id.

    Lines are counted per id first, so no line is handled once for each distinct count. ``n_files`` is the listing's
    number; without it, files with at least one well-formed line are counted.
    """
    ok = ~F.col("is_error")
    per_id = log.groupBy("id").agg(F.count_if(ok).alias("_ok"), F.count_if("is_error").alias("_errors"))
    named = F.col("id").isNotNull()
    lines = per_id.agg(
        F.lit(n_files or 0).cast("bigint").alias("n_files"),
        F.count_if(named & (F.col("_ok") > 0)).alias("n_ok"),
        F.coalesce(F.sum("_errors"), F.lit(0)).alias("n_errors"),
        F.coalesce(F.sum(F.when(~named, F.col("_ok"))), F.lit(0)).alias("n_rejected"),
    )
    if n_files is not None:
        return lines
    none = F.lit(0).cast("bigint")
    files = log.select(file).distinct().agg(
        F.count(F.col(file)).alias("n_files"), none.alias("n_ok"), none.alias("n_errors"), none.alias("n_rejected")
    )
    return lines.unionByName(files).agg(*(F.sum(c).alias(c) for c in lines.columns))


def in_output_order(train: DataFrame) -> DataFrame:
    """Train records in the order their ids were first seen."""
    return train.orderBy("first_seen")


def result_records(
    answers: DataFrame,
    model: str,
    temperature: float = 0.2,
    top_p: float = 0.9,
    max_tokens: int = 512,
    created_at: Column | None = None,
    prompt_version: str | Column | None = None,
) -> DataFrame:
    """Single-video results with their provenance: run id, decoding settings, the frames used, version tags.

    ``answers`` has ``video_id``, ``prompt``, ``answer`` and the frame-plan fields.
    """
    version = F.lit(prompt_version).cast("string") if prompt_version is None or isinstance(prompt_version, str) else prompt_version
    return answers.select(
        "video_id",
        F.lit(model).alias("model"),
        "prompt",
        "answer",
        run_id("prompt", F.lit(model), "sampling_config_hash").alias("run_id"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
        F.struct(
            F.lit(temperature).cast("double").alias("temperature"),
            F.lit(top_p).cast("double").alias("top_p"),
            F.lit(max_tokens).cast("int").alias("max_tokens"),
        ).alias("sampling_params"),
        F.struct("num_frames", "frame_size", "sampling", "sampling_config_hash").alias("frames_ref"),
        version.alias("prompt_version"),
        F.lit(model).alias("model_version"),
        F.col("sampling_config_hash").alias("sampling_version"),
    )
