"""From source shards to the manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelark.functions import media_key, metadata_key, safe_id
from framelark.functions.ids import file_stem
from framelark.operators.dedup import first_per_key
from framelark.operators.pending import ingest_pending, shards_left
from framelark.operators.places import bit_of, bits_before, container_of, has_bit, row_containers
from framelark.sources.files import read_shard_table

FIELDS = {
    "fine_category": "content_fine_category",
    "channel": "youtube_channel",
    "title": "youtube_title",
    "upload_date": "youtube_upload_date",
    "duration": "duration_seconds",
    "resolution": "resolution",
}
MANIFEST_COLUMNS = [
    "video_id", "category", "fine_category", "video_key", "metadata_key",
    "channel", "title", "upload_date", "duration", "resolution",
]


def in_category(shards: DataFrame, category: str) -> DataFrame:
    """Rows of one parent category. Rows without one are dropped."""
    return shards.filter(F.col("json.content_parent_category") == category)


def nested_fields(shards: DataFrame) -> DataFrame:
    """The fields a person looks at first, from both levels of the metadata."""
    return shards.select(
        "shard",
        "row_pos",
        F.col("json.content_parent_category").alias("parent_category"),
        F.col("json.content_fine_category").alias("fine_category"),
        F.col("json.content_metadata.title").alias("title"),
        F.col("json.duration_seconds").alias("duration"),
        F.col("json.resolution").alias("resolution"),
        F.col("json.youtube_title").alias("youtube_title"),
    )


def preview(shards: DataFrame, n: int = 5) -> DataFrame:
    """The first rows of the first shard."""
    return nested_fields(shards).orderBy("shard", "row_pos").limit(n)


def identified(shards: DataFrame, category: str) -> DataFrame:
    """Rows of a category with their id; of rows that share an id, the first.

    Rows are numbered within their shard, which is one file, for those without a usable name.
    """
    narrow = in_category(shards, category).select(
        "shard",
        "row_pos",
        F.col("json.original_video_filename").alias("file_name"),
        *[F.col(f"json.{source}").alias(name) for name, source in FIELDS.items()],
    )
    in_shard = Window.partitionBy("shard").orderBy("row_pos")
    numbered = narrow.withColumn("row_in_shard", (F.row_number().over(in_shard) - 1).cast("bigint"))
    named = numbered.withColumn("video_id", safe_id("file_name", "shard", "row_in_shard"))
    return first_per_key(named, ["video_id"], ["shard", "row_pos"])


def build_manifest(
    shards: DataFrame,
    category: str,
    prefix: str,
    ingested: DataFrame | None = None,
    done_shards: DataFrame | None = None,
) -> DataFrame:
    """Manifest entries of a category, with the shard and row each came from.

    Media bytes are not read. ``ingested`` and ``done_shards`` restrict it to what is new. Done shards are left out before
    the first row of an id is looked for: a name that a done shard has too, but did not store, is taken from its new shard.
    ``done_shards`` here drops rows that were read; where shards are files, ``new_manifest`` does not read them.
    """
    rows = ingest_pending(identified(ingest_pending(shards, None, done_shards), category), ingested)
    entry = rows.withColumns(
        {
            "category": F.lit(category),
            "video_key": media_key(prefix, "video_id"),
            "metadata_key": metadata_key(prefix, "video_id"),
        }
    )
    return entry.select(*MANIFEST_COLUMNS, "shard", "row_pos")


def new_manifest(
    files: DataFrame, category: str, prefix: str, done_shards: DataFrame, ingested: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(manifest entries, source rows) of the shard files that are not done.

    ``files`` is the table of all shard files. Done ones are taken off it before the scan is planned, so they are not
    even opened, and the others keep their numbers: shards, places and ids are those of a scan of all files.
    """
    shards = read_shard_table(shards_left(files, done_shards))
    return build_manifest(shards, category, prefix, ingested), shards


def media_rows(shards: DataFrame, entries: DataFrame, category: str) -> DataFrame:
    """Media bytes and metadata of the given manifest entries of a category, each row with its ``video_id``.

    The media stay where they are read, however many entries there are: no row of the scan is exchanged. Places and names are
    looked at first, without the bytes, and of each shard a bit map of the rows that are not wanted goes to the scan. Ids come
    from the rows themselves, as in ``build_manifest``; rows without a usable name get their number from a second bit map.
    That is at most a quarter of a byte for each row of the category (most shards need no bit at all), so 250 MB for
    a billion videos.
    """
    name = "json.original_video_filename"
    places = in_category(shards, category).select("shard", "row_pos", F.col(name).alias("file_name"))
    known = F.broadcast(row_containers(places, entries, file_stem("file_name") == ""))
    bit = bit_of("row_pos")
    rows = in_category(shards, category).withColumn("container", container_of("row_pos"))
    rows = rows.join(known, ["shard", "container"], "left")
    unwanted = F.coalesce("none", F.lit(False)) | F.coalesce(has_bit(F.col("lost"), bit), F.lit(False))
    number = F.col("earlier") + bits_before(F.col("members"), bit)
    return rows.filter(~unwanted).select(*shards.columns, safe_id(name, "shard", number).alias("video_id"))


def media_objects(rows: DataFrame, prefix: str) -> DataFrame:
    """``key, content``: the media and the metadata of each row of ``media_rows`` as objects."""
    metadata = F.to_json("json", {"ignoreNullFields": "false"}).cast("binary")
    pair = F.array(
        F.struct(media_key(prefix, "video_id").alias("key"), F.col("mp4").alias("content")),
        F.struct(metadata_key(prefix, "video_id").alias("key"), metadata.alias("content")),
    )
    return rows.select(F.explode(pair).alias("o")).select("o.key", "o.content")


def summary(manifest: DataFrame, category: str, prefix: str, n_shards: int | None = None) -> DataFrame:
    """One row: category, prefix, number of videos and of shards (those with a video unless given)."""
    shards = F.lit(n_shards).cast("bigint") if n_shards is not None else F.count_distinct("shard")
    return manifest.agg(
        F.lit(category).alias("category"),
        F.lit(prefix).alias("prefix"),
        F.count(F.lit(1)).alias("total_videos"),
        shards.alias("n_shards"),
    )


def capped(manifest: DataFrame, most: int) -> DataFrame:
    """The first ``most`` entries in source order."""
    return manifest.orderBy("shard", "row_pos").limit(most)
