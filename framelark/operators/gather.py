"""Bringing frame bytes to their video, in listed order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gather_frames(frames: DataFrame, objects: DataFrame, key: str = "key", content: str = "content") -> DataFrame:
    """Contents of the listed frames per video, in listed order, and how many of them are missing.

    ``frames`` has one row per video with the array ``frames``; ``objects`` has one row per key. The list of one video
    is regrouped, never more than what its own row held. A video whose list is empty or null has no contents, none missing.
    """
    listed = frames.select("video_id", F.posexplode_outer("frames").alias("pos", key))
    found = listed.join(objects.select(key, content), key, "left")
    # A video without frames has one row without a position; collect_list leaves its null out.
    one = F.when(F.col("pos").isNotNull(), F.struct("pos", F.col(content)))
    grouped = found.groupBy("video_id").agg(
        F.array_sort(F.collect_list(one)).alias("_items"),
        F.count_if(F.col("pos").isNotNull() & F.col(content).isNull()).alias("n_missing"),
    )
    return grouped.select(
        "video_id", F.transform("_items", lambda i: i[content]).alias("contents"), "n_missing"
    )
