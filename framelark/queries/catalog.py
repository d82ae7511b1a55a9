"""Every operator run over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark import sinks
from framelark.functions import cache_key, config_hash, image_list, image_tokens, safe_id, stage_key
from framelark.operators import gather, histogram, keyindex, labels, pending, sharding
from framelark.operators.dedup import first_per_key, last_per_key
from framelark.operators.layout import with_row_index
from framelark.operators.scoring import score, scoring_input
from framelark.plans import frames as frame_plans
from framelark.plans import ingest, labelling, results, training
from framelark.queries import fixtures as fx
from framelark.schemas import CONTEXT_LIMITS, FRAMES, INFERENCE_MANIFEST, MANIFEST
from framelark.session import new_path
from framelark.sinks.objects import published, read_objects, write_objects
from framelark.sources import (
    list_files,
    read_frames,
    read_lines,
    read_shards,
    shard_paths,
    shard_table,
    text_lines,
    with_line_index,
)
from framelark.sources.jsonl import LINE_ORDER, parse_strict
from framelark.streaming import (
    append_log,
    compact_log,
    compact_tiers,
    merged_log,
    read_progress,
    read_scored,
    score_manifest_stream,
    stream_lines,
)

Query = Callable[[SparkSession, str], DataFrame]
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TEMPLATE = "{{N_FRAMES}} frames, one every {{FRAME_INTERVAL}} s. Domain: {{DOMAIN_HINT}}. Look for: {{TARGET_CLASSES}}."


# Sources and result logs


def jsonl_scan_lenient(spark: SparkSession, sf: str) -> DataFrame:
    return results.parsed(fx.result_log(spark, sf)).select(
        "event_id", "id", "prompt", "output", "model", "error", "is_error"
    )


def manifest_scan_strict(spark: SparkSession, sf: str) -> DataFrame:
    records = fx.inference_records(spark, sf)
    lines = records.select("doc_id", F.to_json(F.struct("id", "prompt", "image", "images")).alias("raw"))
    parsed = parse_strict(lines, INFERENCE_MANIFEST)
    return parsed.select("id", "prompt", "image", F.array_join("images", ",").alias("images"))


def merge_train(spark: SparkSession, sf: str) -> DataFrame:
    return results.merged(fx.result_log(spark, sf), fx.RESULT_ORDER).select(
        "id",
        "raw",
        F.col("first_seen.event_id").alias("first_event"),
        F.col("last_seen.event_id").alias("last_event"),
        "n_records",
    )


def merge_errors(spark: SparkSession, sf: str) -> DataFrame:
    return results.errors(fx.result_log(spark, sf)).select("event_id", "id", "raw")


def merge_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return results.rejected(fx.result_log(spark, sf)).select("event_id", "raw")


def merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    return results.counts(fx.result_log(spark, sf))


def resume_pending(spark: SparkSession, sf: str) -> DataFrame:
    left = pending.resume_pending(fx.some_unnamed(spark, sf), fx.result_log(spark, sf), ["doc_id"])
    return left.select("id", "prompt", "image")


def resume_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """``resume_pending`` against a log stored in runs, one for each remainder of the event, with a key filter each."""
    path = new_path(spark, "log-runs")
    log = fx.result_log(spark, sf).filter(F.col("id").isNotNull()).select("event_id", "id", "raw")
    for part in range(3):
        keyindex.store_run(log.filter(F.col("event_id") % 3 == part).drop("event_id"), path, "id")
    named = fx.some_unnamed(spark, sf).filter(F.col("id").isNotNull())
    return keyindex.unstored(last_per_key(named, ["id"], ["doc_id"]), path, "id").select("id", "prompt", "image")


def manifest_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return pending.rejected_records(fx.some_unnamed(spark, sf)).select("doc_id", "prompt", "image")


def reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    train = results.merged(fx.result_log(spark, sf), fx.RESULT_ORDER)
    return pending.reconcile_counts(fx.some_unnamed(spark, sf), train)


def reconcile_content(spark: SparkSession, sf: str) -> DataFrame:
    """Shards of ten neighbouring records, of which those that differ are named."""
    wanted, made = fx.copied_records(spark, sf)
    shard = F.call_function("div", F.col("doc_id"), F.lit(10))
    return pending.reconcile_content(wanted, made, shard, ["id", "prompt", "image"])


def run_throughput(spark: SparkSession, sf: str) -> DataFrame:
    return histogram.run_throughput(fx.label_results(spark, sf), "prompt", "created_at")


# Sharding


def _numbered_records(spark: SparkSession, sf: str) -> DataFrame:
    """Inference records read from the lines of a manifest, with their line numbers."""
    lines = text_lines(spark, fx.write_manifest_lines(spark, sf), "*.txt")
    return parse_strict(with_line_index(lines), INFERENCE_MANIFEST)


def shard_interleave(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.dealt(_numbered_records(spark, sf), 4).select("id", "row_index", "shard")


def shard_interleave_awk(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.dealt(_numbered_records(spark, sf), 4, base=1).select("id", "shard")


def batch_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.sliced(_numbered_records(spark, sf)).select("id", "chunk")


def table_interleave(spark: SparkSession, sf: str) -> DataFrame:
    """The same for rows of a table, which have no lines: numbered by a global sort."""
    records = fx.inference_records(spark, sf).select("doc_id", "id")
    return sharding.interleaved(records, ["doc_id"], 4).select("id", "row_index", "shard")


# Ingest


def scan_nested_project(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.nested_fields(fx.shard_rows(spark, sf))


def category_filter(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.nested_fields(ingest.in_category(fx.shard_rows(spark, sf), fx.CATEGORY))


def preview_head(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.preview(fx.shard_rows(spark, sf))


def category_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return histogram.value_counts(fx.shard_rows(spark, sf), "json.content_parent_category", "category")


def fine_category_top30(spark: SparkSession, sf: str) -> DataFrame:
    return histogram.value_counts(fx.shard_rows(spark, sf), "json.content_fine_category", "category", top=30)


def manifest_build(spark: SparkSession, sf: str) -> DataFrame:
    return fx.manifest(spark, sf)


def manifest_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.summary(fx.manifest(spark, sf), fx.CATEGORY, fx.PREFIX)


def media_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = ingest.media_rows(fx.shard_rows(spark, sf), fx.manifest(spark, sf), fx.CATEGORY)
    return rows.select(
        "video_id",
        F.length("mp4").cast("bigint").alias("n_bytes"),
        F.sha2("mp4", 256).alias("digest"),
        F.get_json_object(F.to_json("json"), "$.content_metadata.title").alias("title"),
    )


def media_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Two objects for each video, media and metadata, published together and read back."""
    entries = fx.manifest(spark, sf)
    rows = ingest.media_rows(fx.shard_rows(spark, sf), entries, fx.CATEGORY)
    root = new_path(spark, "objects")
    write_objects(ingest.media_objects(rows, fx.PREFIX), "key", "content", root)
    found = read_objects(spark, root)
    return found.select("key", "length", F.sha2("content", 256).alias("digest"))


def ingest_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = histogram.shard_counts(fx.manifest(spark, sf))
    return counts.withColumn("shard", F.coalesce(F.col("shard").cast("string"), F.lit("all")))


def ingest_new_only(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents count as stored, the shard files numbered like a region as done and are not opened."""
    stored = fx.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("video_id"))
    done = fx.table(spark, sf, "region").select(F.col("r_regionkey").cast("int").alias("shard"))
    files = shard_table(spark, list_files(spark, fx.write_shards(spark, sf), "*.parquet"))
    found, _ = ingest.new_manifest(files, fx.CATEGORY, fx.PREFIX, done, stored)
    return found.select("video_id", "video_key", F.col("shard").cast("bigint").alias("shard"), "row_pos")


def media_of_new_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Media of the entries of ``ingest_new_only``, read from the shard files that are not done."""
    stored = fx.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("video_id"))
    done = fx.table(spark, sf, "region").select(F.col("r_regionkey").cast("int").alias("shard"))
    files = shard_table(spark, list_files(spark, fx.write_shards(spark, sf), "*.parquet"))
    entries, shards = ingest.new_manifest(files, fx.CATEGORY, fx.PREFIX, done, stored)
    out = new_path(spark, "media")
    sinks.write_media(ingest.media_rows(shards, entries, fx.CATEGORY), out)
    title = F.get_json_object("metadata", "$.content_metadata.title")
    return spark.read.parquet(out).select("video_id", F.sha2("mp4", 256).alias("digest"), title.alias("title"))


def ingest_cap(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.capped(fx.manifest(spark, sf), 20).select("video_id", "shard", "row_pos")


def safe_id_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_row_index(fx.named_files(spark, sf), ["row_pos"], ["shard"], "row_in_shard")
    named = rows.withColumn("video_id", safe_id("file_name", "shard", "row_in_shard"))
    return first_per_key(named, ["video_id"], ["shard", "row_pos"])


def shard_scan_cap(spark: SparkSession, sf: str) -> DataFrame:
    """The first three shard files that are listed, with the rows of each."""
    paths = shard_paths(spark, fx.write_shards(spark, sf), prefix="part-", cap=3, recursive=True)
    rows = ingest.nested_fields(read_shards(spark, paths))
    return rows.groupBy(F.col("shard").cast("bigint").alias("shard")).agg(
        F.count(F.lit(1)).alias("n"), F.max("row_pos").alias("last_row"), F.min("title").alias("first_title")
    )


def manifest_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest written as lines of JSON and read strictly."""
    out = new_path(spark, "manifest-jsonl")
    sinks.write_jsonl(fx.manifest(spark, sf).drop("shard", "row_pos"), out)
    lines = read_lines(spark, out, "*.json")
    return parse_strict(lines, MANIFEST).drop("file", "block", "line")


def shard_log_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Results appended to the log of each shard in two goes, and read back with the shard."""
    out = new_path(spark, "shard-log")
    rows = fx.inference_records(spark, sf).select("doc_id", "id", "prompt", F.pmod("doc_id", F.lit(4)).alias("shard"))
    for half in (0, 1):
        part = rows.filter(F.col("doc_id") % 2 == half).withColumn("output", F.concat(F.lit("o"), "id"))
        sinks.write_shard_log(part.drop("doc_id"), out)
    log = results.classified(read_lines(spark, out, "*.json"))
    shard = F.regexp_extract("file", r"/shard=(\d+)/", 1).cast("int")
    return log.select("id", F.col("fields")["output"].alias("output"), F.col("fields")["prompt"].alias("prompt"), shard.alias("shard"), "is_error")


# Frames and prompts


def frames_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return fx.frames(spark, sf).select(
        "video_id",
        "num_frames",
        "sampling",
        "frame_size",
        "source_duration",
        F.array_join("frames", ",").alias("frames"),
        "sampling_config_hash",
        "fps",
        F.element_at("times", 2).alias("second_time"),
        F.element_at("times", -1).alias("last_time"),
        "geometry.*",
    )


def _shown_frames(rows: DataFrame) -> DataFrame:
    return rows.select(
        "video_id", "num_frames", "sampling", "frame_size", "source_duration",
        F.array_join("frames", ",").alias("frames"), "sampling_config_hash",
    )


def frames_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Frame plans written as JSON and read back."""
    out = new_path(spark, "frames-json")
    sinks.write_frames(fx.frames(spark, sf).select(*frame_plans.FRAMES_JSON), out)
    return _shown_frames(spark.read.schema(FRAMES).json(out))


def frames_objects(spark: SparkSession, sf: str) -> DataFrame:
    """One ``frames.json`` object for each video, published together, read as whole-file JSON."""
    plans = fx.frames(spark, sf).select(*frame_plans.FRAMES_JSON)
    key = F.concat(F.lit(f"{fx.PREFIX}/"), "video_id", F.lit("/frames.json"))
    root = new_path(spark, "frame-objects")
    write_objects(plans.select(key.alias("key"), F.to_json(F.struct("*")).alias("content")), "key", "content", root)
    return _shown_frames(read_frames(spark, root, published(spark, root)))


def frames_gather_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """Frame contents are hashes of their keys; clips with fewer seconds than frames have only that many objects."""
    plan = fx.frames(spark, sf)
    stored = plan.select("source_duration", F.posexplode("frames").alias("pos", "key"))
    objects = stored.filter(F.col("pos") < F.col("source_duration")).select("key", F.sha2("key", 256).alias("content"))
    found = gather.gather_frames(plan, objects)
    shown = F.transform("contents", lambda c: F.coalesce(c, F.lit("-")))
    return found.select("video_id", F.array_join(shown, ",").alias("contents"), "n_missing")


def resolve_image_uri(spark: SparkSession, sf: str) -> DataFrame:
    records = fx.inference_records(spark, sf).select("id", image_list("images", "image").alias("images"))
    return frame_plans.resolved_images(records, fx.BUCKET, fx.IMAGE_PREFIX)


def inference_manifest(spark: SparkSession, sf: str) -> DataFrame:
    records = frame_plans.inference_manifest(fx.frames(spark, sf), "Describe the clip.")
    return records.select("id", "prompt", F.array_join("images", ",").alias("images"))


def prompt_fill(spark: SparkSession, sf: str) -> DataFrame:
    targets = F.when(F.col("duration") % 2 == 0, F.col("channel")).otherwise("")
    return frame_plans.filled_prompts(fx.manifest(spark, sf), TEMPLATE, F.col("fine_category"), targets)


def probe_expand(spark: SparkSession, sf: str) -> DataFrame:
    return frame_plans.probes_of(fx.frames(spark, sf)).select("video_id", "probe", "prompt", "content")


def token_budget(spark: SparkSession, sf: str) -> DataFrame:
    records = fx.inference_records(spark, sf).select("id", F.size(image_list("images", "image")).alias("n_frames"))
    rows = records.withColumn("tiles", F.explode(F.array(F.lit(1), F.lit(12))))
    rows = rows.withColumn("image_tokens", image_tokens("n_frames", F.col("tiles")))
    return labels.token_budget(rows, CONTEXT_LIMITS).fillna(0)


def token_budget_summary(spark: SparkSession, sf: str) -> DataFrame:
    return labels.budget_summary(token_budget(spark, sf), CONTEXT_LIMITS, ["tiles"])


# Scoring, with a stand-in model that answers with a hash of its message


def _stub_model():
    def load(reference):
        if reference.startswith("/"):
            raise FileNotFoundError(reference)
        return reference

    def make():
        import hashlib

        def generate(batch):
            return [hashlib.sha256(item["messages"][-1]["content"].encode()).hexdigest() + "\n" for item in batch]

        return generate

    return make, load


def _shown_results(scored: DataFrame) -> DataFrame:
    return scored.select("id", "prompt", F.array_join("images", ",").alias("images"), "output", "model", "error")


def batch_infer(spark: SparkSession, sf: str) -> DataFrame:
    make, load = _stub_model()
    return _shown_results(score(scoring_input(fx.inference_records(spark, sf)), make, load, fx.MODEL))


def probe_infer(spark: SparkSession, sf: str) -> DataFrame:
    make, load = _stub_model()
    scored = score(labelling.probe_records(fx.frames(spark, sf)), make, load, fx.MODEL)
    return labelling.probe_answers(scored).select("video_id", "probe", "prompt", "answer", "model")


def video_infer(spark: SparkSession, sf: str) -> DataFrame:
    make, load = _stub_model()
    found, _ = labelling.labelled_videos(fx.frames(spark, sf), "Describe the clip.", make, load, fx.MODEL)
    return found.select("video_id", "model", "prompt", "answer", "run_id", "sampling_params.*", "frames_ref.*")


def _result_records(spark: SparkSession, sf: str) -> DataFrame:
    answers = fx.label_results(spark, sf).withColumns(
        {
            "num_frames": F.lit(16),
            "frame_size": F.lit("448x448"),
            "sampling": F.lit("uniform"),
            "sampling_config_hash": config_hash(16),
        }
    )
    return results.result_records(answers, fx.MODEL, created_at=F.col("created_at"), prompt_version=F.col("prompt"))


def result_records(spark: SparkSession, sf: str) -> DataFrame:
    return _result_records(spark, sf).select(
        "video_id",
        "model",
        "prompt",
        "answer",
        "run_id",
        F.date_format("created_at", TIME_TEXT).alias("created_at"),
        "sampling_params.*",
        "frames_ref.*",
        "prompt_version",
        "model_version",
        "sampling_version",
    )


def single_result_store(spark: SparkSession, sf: str) -> DataFrame:
    """Results written twice over, read back as the newest of each video and run."""
    path = new_path(spark, "results")
    records = _result_records(spark, sf)
    sinks.write_single_results(records, path)
    sinks.write_single_results(records, path)
    return sinks.current_results(spark, path).select(
        "video_id", "run_id", "answer", F.date_format("created_at", TIME_TEXT).alias("created_at")
    )


# Labels


def latest_label(spark: SparkSession, sf: str) -> DataFrame:
    newest = labels.latest_label(fx.label_results(spark, sf), ["created_at", "event_id"])
    return newest.select("video_id", "event_id", "prompt", "answer")


def _changes(spark: SparkSession, sf: str, **options) -> DataFrame:
    found = labels.label_changes(fx.label_results(spark, sf), ["created_at", "event_id"], **options)
    return found.select("event_id", "video_id", "answer", "previous_answer", "changed")


def label_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _changes(spark, sf)


def label_changes_hot_video(spark: SparkSession, sf: str) -> DataFrame:
    """The same over many more sorted partitions than usual, so that most videos run over from one to the next."""
    return _changes(spark, sf, parts=64)


def _requests(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Every video with every prompt as wanted; answers worth at least 150 as cached."""
    answered = fx.label_results(spark, sf)
    keyed = answered.withColumns(
        {
            "cache_key": cache_key("video_id", config_hash(16), "prompt", F.lit(fx.MODEL), F.lit("t=0.2")),
            "frames_key": stage_key(video_id="video_id", sampling=config_hash(16)),
        }
    )
    return keyed.select("video_id", "prompt", "cache_key", "frames_key").distinct(), keyed.filter(F.col("value") >= 150)


def cache_pending(spark: SparkSession, sf: str) -> DataFrame:
    fresh = pending.cache_pending(*_requests(spark, sf))
    return fresh.select("video_id", "prompt", "cache_key", "frames_cached")


def cache_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Wanted answers whose key is in no stored run, one run for each prompt, with a key filter each."""
    wanted, cached = _requests(spark, sf)
    path = new_path(spark, "cached-runs")
    for prompt in ("click", "view", "purchase", "error", "signup"):
        keyindex.store_run(cached.filter(F.col("prompt") == prompt).select("cache_key", "answer"), path, "cache_key")
    return keyindex.unstored(wanted, path, "cache_key").select("video_id", "prompt", "cache_key")


def dev_subset(spark: SparkSession, sf: str) -> DataFrame:
    seconds = F.col("json.duration_seconds")
    length = F.when(seconds < 500, "short").when(seconds < 3000, "medium").otherwise("long")
    videos = fx.shard_rows(spark, sf).select(
        F.col("row_pos").cast("string").alias("video_id"),
        F.col("json.content_parent_category").alias("category"),
        length.alias("length"),
    )
    return labels.dev_subset(videos, ["category", "length"], 5)


def dev_subset_total(spark: SparkSession, sf: str) -> DataFrame:
    """Forty videos in all, mixed by category, length and whether they have questions in them (a word of asking)."""
    docs = fx.table(spark, sf, "documents")
    length = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 3000, "medium").otherwise("long")
    videos = docs.select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.col("lang").alias("category"),
        length.alias("length"),
        F.contains("text", F.lit(":")).alias("dialogue"),
    )
    return labels.dev_subset(videos, ["category", "length", "dialogue"], total=40)


def label_validate(spark: SparkSession, sf: str) -> DataFrame:
    return labels.validated(fx.label_answers(spark, sf)).drop("answer", "lang")


def label_quality(spark: SparkSession, sf: str) -> DataFrame:
    return labels.label_quality(fx.label_answers(spark, sf), "lang")


def label_quality_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Parsing, rules, agreement with the wanted label and repetition, per prompt version."""
    return labels.label_quality(fx.versioned_answers(spark, sf), "prompt_version", gold="gold", told="summary")


def longest_phrase(spark: SparkSession, sf: str) -> DataFrame:
    return labels.longest_phrases(fx.table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


def repetition_rate(spark: SparkSession, sf: str) -> DataFrame:
    return labels.repetition(fx.table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


def language_compliance(spark: SparkSession, sf: str) -> DataFrame:
    texts = fx.table(spark, sf, "documents").select("doc_id", "lang", "text")
    return labels.language_compliance(texts, "text", "A-Za-z", least=0.95).drop("text")


def field_agreement(spark: SparkSession, sf: str) -> DataFrame:
    student = fx.table(spark, sf, "documents").select(
        "doc_id",
        "lang",
        (F.col("n_chars") > 1000).cast("int").alias("quality"),
        (F.col("n_chars") < 100).cast("int").alias("toxic"),
    )
    teacher = fx.table(spark, sf, "labels").select(
        "doc_id", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")
    )
    return labels.field_agreement(student, teacher, ["doc_id"], ["quality", "toxic"], by=["lang"])


def teacher_student_join(spark: SparkSession, sf: str) -> DataFrame:
    teacher, student = fx.model_answers(spark, sf)
    return training.paired_answers(teacher, student, ["turn"])


def teacher_student_report(spark: SparkSession, sf: str) -> DataFrame:
    return training.comparison_report(teacher_student_join(spark, sf), "A-Za-z")


def sft_rows(spark: SparkSession, sf: str) -> DataFrame:
    planned = frame_plans.with_frame_plan(fx.manifest(spark, sf), fx.PREFIX)
    rows = training.planned_training_rows(planned, fx.conversation_labels(spark, sf), ["turn"])
    return rows.select(
        "video_id",
        "category",
        "fine_category",
        "prompt",
        "target",
        F.array_join("frames", ",").alias("frames"),
        F.element_at("messages", 1)["content"].alias("content"),
    )


# Streams


def _write_log_files(spark: SparkSession, sf: str) -> str:
    """Result lines as text files whose order by path and line is the order of the events."""
    path = new_path(spark, "result-log")
    # The order starts with the folder, so the writer has nothing to sort again.
    lines = fx.result_lines(spark, sf).orderBy("day", *fx.RESULT_ORDER)
    lines.select(F.col("raw").alias("value"), "day").write.partitionBy("day").text(path)
    return path


def _stream_log(spark: SparkSession, sf: str, files_per_batch: int = 16) -> str:
    source, log = _write_log_files(spark, sf), new_path(spark, "stream-log")
    lines = stream_lines(spark, source, "*.txt", files_per_batch)
    append_log(lines, log, new_path(spark, "stream-checkpoint")).awaitTermination()
    return log


def merge_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Log files are read, merged, written and read again."""
    out = new_path(spark, "merged")
    log = results.classified(read_lines(spark, _write_log_files(spark, sf), "*.txt"))
    sinks.write_merge(log, LINE_ORDER, out)
    again = results.classified(read_lines(spark, f"{out}/train.jsonl", "*.txt"))
    return again.select("id", "raw")


def stream_merge(spark: SparkSession, sf: str) -> DataFrame:
    return merged_log(spark, _stream_log(spark, sf)).select("id", "raw", "n_records")


def stream_compact(spark: SparkSession, sf: str) -> DataFrame:
    """The log in runs of like size, read by its manifest; it equals the log as it came."""
    log = _stream_log(spark, sf, files_per_batch=4)
    compact_tiers(spark, log, fanout=3)
    return merged_log(spark, log).select("id", "raw", "n_records")


def stream_compact_whole(spark: SparkSession, sf: str) -> DataFrame:
    """The log rewritten as a whole."""
    compacted = new_path(spark, "compact-log")
    compact_log(spark, compacted, _stream_log(spark, sf))
    return merged_log(spark, compacted).select("id", "raw", "n_records")


def _score_stream(spark: SparkSession, sf: str) -> tuple[str, str]:
    """The inference records of three files scored as a stream, one file a batch: where results and progress are."""
    source, scored, progress = (new_path(spark, name) for name in ("manifest", "scored", "progress"))
    fields = F.struct("id", "prompt", "image", "images")
    lines = fx.inference_records(spark, sf).select(F.to_json(fields).alias("value"), (F.col("doc_id") % 3).alias("part"))
    lines.repartition(3, "part").write.partitionBy("part").option("compression", "none").text(source)
    make, load = _stub_model()
    score_manifest_stream(
        spark, source, scored, new_path(spark, "score-checkpoint"), make, load, fx.MODEL, files_per_batch=1,
        pattern="*.txt", progress_path=progress,
    ).awaitTermination()
    return scored, progress


def stream_infer(spark: SparkSession, sf: str) -> DataFrame:
    return _shown_results(read_scored(spark, _score_stream(spark, sf)[0]))


def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """What the batches said of themselves while they ran, without their times."""
    found = read_progress(spark, _score_stream(spark, sf)[1])
    return found.select("processed", "errors", (F.col("per_second") > 0).alias("timed"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        jsonl_scan_lenient, manifest_scan_strict, merge_train, merge_errors, merge_rejects, merge_counts,
        resume_pending, manifest_rejects, reconcile_counts, merge_round_trip, run_throughput, shard_interleave, shard_interleave_awk, batch_chunks,
        table_interleave, media_of_new_shards, media_objects,
        reconcile_content, shard_scan_cap, manifest_round_trip, shard_log_round_trip, frames_round_trip, frames_objects,
        dev_subset_total, label_quality_versions, longest_phrase, resume_indexed, cache_indexed,
        scan_nested_project, category_filter, preview_head, category_histogram, fine_category_top30,
        manifest_build, manifest_summary, media_rows, ingest_counts, ingest_new_only, ingest_cap,
        safe_id_first_wins, frames_manifest, frames_gather_ordered, resolve_image_uri, inference_manifest,
        prompt_fill, probe_expand, token_budget, token_budget_summary, batch_infer, probe_infer, video_infer, result_records, single_result_store, latest_label,
        label_changes, label_changes_hot_video, cache_pending, dev_subset, label_validate, label_quality,
        repetition_rate, language_compliance, field_agreement, teacher_student_join, teacher_student_report,
        sft_rows, stream_merge, stream_compact, stream_compact_whole, stream_infer, stream_progress,
    )
}
