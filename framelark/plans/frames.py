"""From the manifest to frame plans and inference input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.functions import (
    config_hash,
    duration_seconds_int,
    fill_template,
    frame_interval,
    frame_keys,
    frame_times,
    image_tokens,
    letterbox,
    resolve_uri,
    sampling_fps,
    video_prompt,
)
from framelark.schemas import FRAME_SIZE, N_FRAMES, PROBES, SAMPLING


def _plan_columns(prefix: str, n: int) -> list[Column]:
    return [
        F.lit(n).alias("num_frames"),
        F.lit(SAMPLING).alias("sampling"),
        F.lit(FRAME_SIZE).alias("frame_size"),
        duration_seconds_int("duration").alias("source_duration"),
        frame_keys(prefix, "video_id", n).alias("frames"),
        config_hash(n).alias("sampling_config_hash"),
        sampling_fps("duration", n).alias("fps"),
        frame_times("duration", n).alias("times"),
        letterbox("resolution").alias("geometry"),
    ]


def frame_plan(manifest: DataFrame, prefix: str, n: int = N_FRAMES) -> DataFrame:
    """What to sample from each video: frame keys in time order, rate, times, geometry, configuration hash.

    One row in, one row out; how videos are spread over workers is the partitioning of the manifest.
    """
    return manifest.select("video_id", *_plan_columns(prefix, n))


def with_frame_plan(manifest: DataFrame, prefix: str, n: int = N_FRAMES) -> DataFrame:
    """Manifest entries with their frame plan beside them, for what needs both: no join of the manifest with itself."""
    return manifest.select("*", *_plan_columns(prefix, n))


FRAMES_JSON = [
    "video_id", "num_frames", "sampling", "frame_size", "source_duration", "frames", "sampling_config_hash",
]


def inference_manifest(frames: DataFrame, prompt: str | Column | None = None) -> DataFrame:
    """Frame plans as inference records: the video is the id, its frames are the images."""
    text = F.lit(prompt).cast("string") if prompt is None or isinstance(prompt, str) else prompt
    return frames.select(F.col("video_id").alias("id"), text.alias("prompt"), F.col("frames").alias("images"))


def resolved_images(records: DataFrame, bucket: str, prefix: str) -> DataFrame:
    """One row per referenced image with where it is."""
    listed = records.select("id", F.posexplode("images").alias("pos", "reference"))
    return listed.select("id", "pos", "reference", resolve_uri("reference", bucket, prefix).alias("uri")).select(
        "id", "pos", "reference", "uri.*"
    )


def probes_of(frames: DataFrame, probes: tuple[tuple[str, str], ...] = PROBES) -> DataFrame:
    """Every probe on the same frames: the fixed probe list is a literal, so no join is needed."""
    listed = F.array(*[F.struct(F.lit(k).alias("probe"), F.lit(p).alias("prompt")) for k, p in probes])
    rows = frames.select("video_id", "frames", F.inline(listed))
    return rows.withColumn("content", video_prompt(F.size("frames"), "prompt"))


def filled_prompts(
    manifest: DataFrame, template: str, domain_hint: str | Column, target_classes: str | Column, n: int = N_FRAMES
) -> DataFrame:
    """The user prompt of each video from a template."""
    interval = frame_interval("duration", n)
    text = fill_template(template, F.lit(n), interval, domain_hint, target_classes)
    return manifest.select("video_id", interval.alias("frame_interval"), text.alias("prompt"))


def with_image_tokens(frames: DataFrame, tiles: int = 1) -> DataFrame:
    return frames.withColumn("image_tokens", image_tokens(F.size("frames"), tiles))
