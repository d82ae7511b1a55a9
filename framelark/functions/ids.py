"""Ids, object keys and references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_stem(file_name: ColumnOrName) -> Column:
    """A file name without folder and extension, everything but letters, digits, ``_`` and ``-`` turned to ``_``.

    Outer underscores are dropped, so the result may be empty.
    """
    base = F.regexp_replace(F.coalesce(_col(file_name), F.lit("")), r"(?s)^.*/", "")
    stem = F.regexp_replace(base, r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")
    return F.btrim(F.regexp_replace(stem, r"[^A-Za-z0-9_-]", "_"), F.lit("_"))


def safe_id(file_name: ColumnOrName, shard: ColumnOrName, row: ColumnOrName) -> Column:
    """The file's stem as an id; ``shard00000_row000000`` from its position where the stem is empty."""
    stem = file_stem(file_name)
    return F.when(stem != "", stem).otherwise(F.format_string("shard%05d_row%06d", _col(shard), _col(row)))


def shard_file(shard: ColumnOrName) -> Column:
    return F.format_string("shard-%05d.jsonl", _col(shard))


def media_key(prefix: str, video_id: ColumnOrName) -> Column:
    return F.concat(F.lit(f"{prefix}/"), _col(video_id), F.lit("/video.mp4"))


def metadata_key(prefix: str, video_id: ColumnOrName) -> Column:
    return F.concat(F.lit(f"{prefix}/"), _col(video_id), F.lit("/metadata.json"))


def result_key(prefix: str, video_id: ColumnOrName, run: ColumnOrName) -> Column:
    return F.concat(F.lit(f"{prefix}/"), _col(video_id), F.lit("/inference/"), _col(run), F.lit(".json"))


def join_path(prefix: ColumnOrName, key: ColumnOrName) -> Column:
    """Prefix and key with exactly one slash between them; the key alone if the prefix is empty."""
    p, k = _col(prefix), _col(key)
    joined = F.concat_ws("/", F.regexp_replace(p, "/+$", ""), F.regexp_replace(k, "^/+", ""))
    return F.when(F.coalesce(p, F.lit("")) == "", k).otherwise(joined)


def resolve_uri(reference: ColumnOrName, bucket: str, prefix: str = "") -> Column:
    """Where an image reference points: struct of scheme, bucket and key.

    ``s3://`` names its own bucket, ``http(s)://`` is kept whole as the key, all else lies under ``prefix``
    in ``bucket``.
    """
    ref = _col(reference)
    own_bucket = r"^s3://([^/]*)/?(.*)$"
    remote = F.struct(
        F.lit("s3").alias("scheme"),
        F.regexp_extract(ref, f"(?s){own_bucket}", 1).alias("bucket"),
        F.regexp_extract(ref, f"(?s){own_bucket}", 2).alias("key"),
    )
    web = F.struct(
        F.substring_index(ref, "://", 1).alias("scheme"), F.lit(None).cast("string").alias("bucket"), ref.alias("key")
    )
    local = F.struct(
        F.lit("s3").alias("scheme"), F.lit(bucket).alias("bucket"), join_path(F.lit(prefix), ref).alias("key")
    )
    return (
        F.when(ref.isNull(), F.lit(None))
        .when(ref.startswith("s3://"), remote)
        .when(ref.startswith("http://") | ref.startswith("https://"), web)
        .otherwise(local)
    )


def first_nonempty(value: ColumnOrName, default: ColumnOrName) -> Column:
    """The value, or the default where it is null or the empty string."""
    return F.coalesce(F.nullif(_col(value), F.lit("")), _col(default))


def image_list(images: ColumnOrName, image: ColumnOrName) -> Column:
    """The list of references; a single one where the list is null or empty; else an empty list."""
    one, many = _col(image), _col(images)
    none = F.array().cast("array<string>")
    return (
        F.when(F.coalesce(F.size(many), F.lit(0)) > 0, many)
        .when(F.coalesce(one, F.lit("")) != "", F.array(one))
        .otherwise(none)
    )
