"""Per-video JSON objects and frame bytes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark.schemas import FRAMES, SINGLE_RESULT
from framelark.sources.files import read_listed


def _objects(spark: SparkSession, path: str, pattern: str):
    return spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")


def _json_text(content: bytes) -> str:
    """The text of a JSON file in its own encoding; what is no text is left broken, so that it is read as a row of nulls."""
    try:
        return content.decode(json.detect_encoding(content))
    except UnicodeDecodeError:
        return "{"


def read_frames(spark: SparkSession, path: str, listed: DataFrame | None = None) -> DataFrame:
    """All ``frames.json`` objects below ``path``, one row each.

    ``listed`` has ``path`` (below the given one) and ``length`` of all objects, such as ``sinks.objects.published`` gives:
    tasks then open those of that name. Without it Spark lists the folder, and the driver gets the name of every object.
    """
    if listed is None:
        return _objects(spark, path, "frames.json").schema(FRAMES).json(path, multiLine=True)
    named = listed.filter(F.substring_index("path", "/", -1) == "frames.json")
    texts = read_listed(named, path).select("content").rdd.map(lambda row: _json_text(bytes(row["content"])))
    return spark.read.schema(FRAMES).json(texts)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All single-video result objects below ``path``, one row each."""
    return _objects(spark, path, "*.json").schema(SINGLE_RESULT).json(path, multiLine=True)


def read_frame_bytes(spark: SparkSession, root: str, pattern: str = "*.jpg") -> DataFrame:
    """Frame objects below ``root``: ``key`` (path relative to the root), ``content`` and ``length``."""
    files = _objects(spark, root, pattern).format("binaryFile").load(root)
    # Listed paths carry a scheme that the given root may lack, so cut after the root wherever it stands.
    bare = root.split("://", 1)[-1].replace("file:", "").strip("/")
    key = F.regexp_replace(F.col("path"), rf"^.*?\Q{bare}\E/+", "")
    return files.select(key.alias("key"), "content", "length")
