"""Labelling videos from their frames: one prompt per video, or every probe per video."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.functions import chat_messages, video_prompt
from framelark.operators.scoring import Generate, score
from framelark.plans.frames import probes_of
from framelark.plans.results import result_records
from framelark.schemas import VIDEO_PROMPT
from framelark.session import staged

PROBE_SEPARATOR = "#"
FRAME_FIELDS = ["num_frames", "frame_size", "sampling", "sampling_config_hash"]


def video_records(frames: DataFrame, prompt: str = VIDEO_PROMPT, carry: list[str] | None = None) -> DataFrame:
    """Scoring input with one record per video: its frames, tagged in time order, the prompt, and columns to carry."""
    messages = chat_messages(video_prompt(F.size("frames"), F.lit(prompt)))
    return frames.select(
        F.col("video_id").alias("id"), F.lit(prompt).alias("prompt"), F.col("frames").alias("images"), messages.alias("messages"),
        *(carry or []),
    )


def probe_records(frames: DataFrame) -> DataFrame:
    """Scoring input with one record per video and probe; ``id`` is both, joined by ``#``."""
    return probes_of(frames).select(
        F.concat_ws(PROBE_SEPARATOR, "video_id", "probe").alias("id"),
        "prompt",
        F.col("frames").alias("images"),
        chat_messages("content").alias("messages"),
    )


def video_of_probe() -> Column:
    """Spreading probe records by their video lets the probes of a video share its loaded frames."""
    return F.substring_index("id", PROBE_SEPARATOR, 1)


def probe_answers(scored: DataFrame) -> DataFrame:
    """Scored probe records by video and probe."""
    # Video ids hold letters, digits, "_" and "-" only.
    return scored.select(
        video_of_probe().alias("video_id"),
        F.substring_index("id", PROBE_SEPARATOR, -1).alias("probe"),
        "prompt",
        F.col("output").alias("answer"),
        "model",
        "error",
    )


def labelled_videos(
    frames: DataFrame,
    prompt: str,
    model_factory: Callable[[], Generate],
    load_image: Callable[[str], Any],
    model: str,
    created_at: Column | None = None,
    **options: Any,
) -> tuple[DataFrame, DataFrame]:
    """Result records with provenance for the videos that were answered, and the records of those that failed.

    Every video is scored once: the scores are written to the shared folder before this returns, and both results are
    read from there.
    """
    records = video_records(frames, prompt, FRAME_FIELDS)
    scored = staged(score(records, model_factory, load_image, model, carry=FRAME_FIELDS, **options), "scored")
    answers = scored.filter(F.col("error").isNull()).select(
        F.col("id").alias("video_id"), "prompt", F.col("output").alias("answer"), *FRAME_FIELDS
    )
    failed = scored.filter(F.col("error").isNotNull()).select("id", "prompt", "error")
    return result_records(answers, model, created_at=created_at), failed
