"""The given tables read as the entities of the data model. Each adapter keeps every row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelark.plans import frames as frame_plans
from framelark.plans import ingest
from framelark.plans.results import classified
from framelark.session import new_path
from framelark.sinks.versions import exists

CATEGORY = "en"
PREFIX = "media/en"
BUCKET = "media-store"
IMAGE_PREFIX = "input/images/"
MODEL = "/models/teacher"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def result_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as the text of a result log: one line each, one shard file per day, in time order.

    The smallest values make torn and blank lines, the largest ones lines without an id.
    """
    value, props = F.col("value"), F.replace(F.col("props"), F.lit('"'), F.lit('\\"'))
    ident = F.when(value >= 200, F.lit("")).otherwise(F.concat(F.lit('"id": '), F.col("user_id"), F.lit(", ")))
    message = F.when((value >= 100) & (value < 120), F.lit("null")).otherwise(
        F.concat(F.lit('"load: '), props, F.lit('"'))
    )
    failed = F.concat(F.lit('"error": '), message, F.lit(', "prompt": "error"'))
    answered = F.concat(
        F.lit('"prompt": "'), F.col("event_type"), F.lit('", "output": "'), props, F.lit('", "model": "m1"')
    )
    body = F.concat(F.lit("{"), ident, F.when(F.col("event_type") == "error", failed).otherwise(answered))
    raw = (
        F.when(value < 1.0, body)
        .when(value < 1.2, F.lit("  "))
        .otherwise(F.concat(body, F.lit("}")))
    )
    day = F.unix_date(F.to_date("ts"))
    file = F.format_string("shard-%05d.jsonl", day)
    return table(spark, sf, "events").select("event_id", "ts", day.alias("day"), file.alias("file"), raw.alias("raw"))


RESULT_ORDER = ["ts", "event_id"]


def result_log(spark: SparkSession, sf: str) -> DataFrame:
    return classified(result_lines(spark, sf))


def shard_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as source shard rows, a hundred to a shard. The text bytes stand for the media."""
    doc = F.col("doc_id")
    resolution = F.when(doc % 3 == 0, "640x360").when(doc % 3 == 1, "360x640").otherwise("1920x1080")
    title = F.concat(F.lit("Clip "), doc, F.lit(" of "), F.col("source"))
    meta = F.struct(
        F.col("lang").alias("content_parent_category"),
        F.col("source").alias("content_fine_category"),
        F.struct(title.alias("title")).alias("content_metadata"),
        F.concat(F.lit("src/"), doc, F.lit(".mp4")).alias("original_video_filename"),
        F.concat(F.lit("channel-"), F.col("source")).alias("youtube_channel"),
        title.alias("youtube_title"),
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (doc % 1000).cast("int")), "yyyyMMdd").alias(
            "youtube_upload_date"
        ),
        F.col("n_chars").alias("duration_seconds"),
        resolution.alias("resolution"),
    )
    return table(spark, sf, "documents").select(
        F.call_function("div", doc, F.lit(100)).alias("shard"),
        doc.alias("row_pos"),
        F.col("text").cast("binary").alias("mp4"),
        meta.alias("json"),
    )


_WRITTEN: dict[tuple[str, str, str], str] = {}


def source_files(spark: SparkSession, sf: str, name: str, write: Callable[[str], None]) -> str:
    """The folder with some of the tables as source files, which an application writes once, before queries read them."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _WRITTEN or not exists(spark, f"{_WRITTEN[key]}/_SUCCESS"):
        path = new_path(spark, name)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def write_shards(spark: SparkSession, sf: str) -> str:
    """``shard_rows`` as one file for each shard; the folder they are in."""
    rows = shard_rows(spark, sf).select(F.format_string("%08d", "shard").alias("part"), "row_pos", "mp4", "json")
    rows = rows.repartition("part").sortWithinPartitions("part", "row_pos").drop("row_pos")
    return source_files(spark, sf, "shards", lambda path: rows.write.partitionBy("part").parquet(path))


def write_manifest_lines(spark: SparkSession, sf: str) -> str:
    """``inference_records`` as lines of JSON in the order of ``doc_id``; the folder they are in."""
    fields = F.struct("id", "prompt", "image", "images")
    lines = inference_records(spark, sf).orderBy("doc_id").select(F.to_json(fields).alias("value"))
    return source_files(spark, sf, "manifest-lines", lambda path: lines.write.text(path))


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.build_manifest(shard_rows(spark, sf), CATEGORY, PREFIX)


def frames(spark: SparkSession, sf: str) -> DataFrame:
    return frame_plans.frame_plan(manifest(spark, sf), PREFIX)


def named_files(spark: SparkSession, sf: str) -> DataFrame:
    """Page urls as source file names: with query strings, trailing slashes and colliding last segments."""
    return table(spark, sf, "pages").select(
        F.call_function("div", F.col("page_id"), F.lit(100)).alias("shard"),
        F.col("page_id").alias("row_pos"),
        F.col("url").alias("file_name"),
    )


def inference_records(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as inference manifest records with none, one or sixteen images in all forms of reference."""
    doc = F.col("doc_id")
    prompt = F.when(doc % 3 == 1, "").when(doc % 3 == 2, F.concat(F.lit("Describe "), F.col("source")))
    image = F.when(doc % 4 == 1, F.concat(F.lit("https://img.example.com/"), doc, F.lit(".jpg"))).when(
        doc % 4 == 3, F.concat(F.lit("/stills/"), doc, F.lit(".jpg"))
    )
    names = F.array(*[F.lit(f"/frame_{i:03d}.jpg") for i in range(1, 17)])
    many = F.transform(names, lambda n: F.concat(F.lit("s3://media/clips/"), doc, n))
    images = F.when(doc % 4 == 2, many).when(doc % 4 == 3, F.array().cast("array<string>"))
    return table(spark, sf, "documents").select(
        "doc_id", doc.cast("string").alias("id"), prompt.alias("prompt"), image.alias("image"), images.alias("images")
    )


def label_results(spark: SparkSession, sf: str) -> DataFrame:
    """Events as answers with a history: several prompts and several answers per video."""
    return table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("video_id"),
        F.col("event_type").alias("prompt"),
        F.col("props").alias("answer"),
        F.col("ts").alias("created_at"),
        "value",
    )


def some_unnamed(spark: SparkSession, sf: str) -> DataFrame:
    """Inference records of which every seventh has no id."""
    return inference_records(spark, sf).withColumn("id", F.when(F.col("doc_id") % 7 != 3, F.col("id")))


def label_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as label JSON that keeps or breaks each rule of the schema; some fenced, some cut off."""
    n = F.col("n_chars")
    pair = F.struct(F.lit("q").alias("q"), F.col("source").alias("a"))
    qa = (
        F.when(n % 4 == 0, F.array().cast("array<struct<q: string, a: string>>"))
        .when(n % 4 == 3, F.array(pair, pair))
        .otherwise(F.array(pair, pair, pair))
    )
    objects = F.when(n % 5 == 0, F.array("lang", "source", "lang")).otherwise(F.array("lang", "source"))
    label = F.struct(
        F.col("source").alias("scene"),
        F.when(n % 8 == 0, F.array().cast("array<string>")).otherwise(F.split("text", "\n")).alias("actions"),
        objects.alias("objects"),
        F.lit("static").alias("camera"),
        F.col("text").alias("summary"),
        qa.alias("qa"),
        F.when(n % 3 == 0, "low").when(n % 3 == 1, "high").otherwise("unsure").alias("confidence"),
    )
    whole = F.to_json(label)
    answer = (
        F.when(n % 11 == 0, F.concat(F.lit("```json\n"), whole, F.lit("\n```")))
        .when(n % 13 == 0, F.regexp_replace(whole, "}$", ""))
        .otherwise(whole)
    )
    return table(spark, sf, "documents").select("doc_id", "lang", answer.alias("answer"))


def model_answers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Assistant turns as answers of two models: turns alternate between teacher and student, four turns a probe."""
    turn = F.col("turn")
    said = (
        table(spark, sf, "conversations")
        .filter(F.col("role") == "assistant")
        .select(
            F.col("conv_id").cast("string").alias("video_id"),
            F.call_function("div", turn, F.lit(4)).alias("probe"),
            "turn",
            F.col("text").alias("answer"),
        )
    )
    half = F.call_function("div", turn, F.lit(2)) % 2
    return said.filter(half == 0), said.filter(half == 1)


def conversation_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Assistant turns as labels of the video with the conversation's number, each prompted by the turn before it."""
    said = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("video_id"), "turn", "role", "text")
    before = Window.partitionBy("video_id").orderBy("turn")
    asked = F.when(F.lag("turn").over(before) == F.col("turn") - 1, F.lag("text").over(before))
    rows = said.withColumn("prompt", F.coalesce(asked, F.lit(""))).filter(F.col("role") == "assistant")
    return rows.select("video_id", "turn", "prompt", F.col("text").alias("answer"))


def versioned_answers(spark: SparkSession, sf: str) -> DataFrame:
    """``label_answers`` of four prompt versions, each with the label it should have been."""
    n = F.col("n_chars")
    gold = F.struct(
        F.col("source").alias("scene"),
        F.when(n % 7 == 0, "moving").otherwise("static").alias("camera"),
        F.when(n % 3 == 0, "low").when(n % 3 == 1, "high").otherwise("medium").alias("confidence"),
    )
    told = F.when(n % 17 == 0, "no label").otherwise(F.to_json(gold))
    version = F.concat(F.lit("v"), F.col("doc_id") % 4)
    docs = table(spark, sf, "documents")
    named = docs.select("doc_id", version.alias("prompt_version"), told.alias("gold"))
    return label_answers(spark, sf).join(named, "doc_id")


def copied_records(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Inference records, and a copy of which some are gone, some changed, some there twice and some new."""
    rows = inference_records(spark, sf).select("doc_id", "id", "prompt", "image")
    doc = F.col("doc_id")
    kept = rows.filter(~((doc % 320 >= 40) & (doc % 320 < 50) & (doc % 3 == 0)))
    swapped = (doc % 320 >= 90) & (doc % 320 < 92)
    copy = kept.withColumn("prompt", F.when(swapped, F.concat(F.lit("other "), "id")).otherwise(F.col("prompt")))
    twice = rows.filter(doc % 320 == 155)
    new = rows.filter(doc % 320 == 211).withColumn("id", F.concat(F.lit("new-"), "id"))
    return rows, copy.unionByName(twice).unionByName(new)
