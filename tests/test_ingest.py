"""Ingest from written shard files to media, manifest and frame objects."""

import json

import pytest
from pyspark.sql import functions as F

from framelark.operators import histogram
from framelark.operators.gather import gather_frames
from framelark.plans import frames as frame_plans
from framelark.plans import ingest
from framelark.schemas import MANIFEST, SHARD_ROW
from framelark.sinks import (
    current_results,
    export_objects,
    write_frames,
    write_jsonl,
    write_media,
    write_shard_log,
    write_single_results,
    write_summary,
)
from framelark.sources import (
    parse_strict,
    read_frame_bytes,
    read_frames,
    read_lines,
    read_results,
    read_shard_table,
    read_shards,
    shard_paths,
    shard_table,
)


def video(name, category="Sports", fine="Fine", duration=62, resolution="640x360"):
    meta = (category, fine, (f"title {name}",), name, "channel", f"yt {name}", "20240129", duration, resolution)
    return (bytearray(f"bytes of {name}", "utf-8"), meta)


SHARDS = [
    [video("a.mp4"), video("b.mp4", "Music"), video("dir/"), video("c d.mp4")],
    [video("c_d.mp4", fine="collides"), video("b.mp4"), video("e.mp4", None)],
    [video(None), video("f.mp4", duration=27, resolution="360x640")],
]


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("source")
    for i, rows in enumerate(SHARDS):
        spark.createDataFrame(rows, SHARD_ROW).coalesce(1).write.parquet(str(root / f"tmp{i}"))
        part = next((root / f"tmp{i}").glob("part-*.parquet"))
        (root / f"train-{i:05d}-of-00003.parquet").write_bytes(part.read_bytes())
    (root / "other-00000.parquet").write_bytes(b"not a shard")
    return str(root)


@pytest.fixture(scope="module")
def shards(spark, source):
    return read_shards(spark, shard_paths(spark, source))


def test_shards_are_found_in_order(spark, source):
    names = [p.rsplit("/", 1)[1] for p in shard_paths(spark, source)]
    assert names == [f"train-{i:05d}-of-00003.parquet" for i in range(3)]
    assert shard_paths(spark, source, cap=2) == shard_paths(spark, source)[:2]


def test_scan_reads_only_the_selected_nested_fields(shards):
    plan = shards.select("json.content_parent_category")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<json:struct<content_parent_category:string>>" in plan
    narrow = ingest.in_category(shards, "Sports").select("json.content_metadata.title")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(json.content_parent_category,Sports)" in plan and "mp4" not in plan


def test_manifest(shards):
    rows = ingest.build_manifest(shards, "Sports", "p/sports").orderBy("shard", "row_pos").collect()
    # "dir/" and the missing name are named by their place among the rows of the category.
    assert [r.video_id for r in rows] == ["a", "shard00000_row000001", "c_d", "b", "shard00002_row000000", "f"]
    assert rows[2].fine_category == "Fine" and rows[0].video_key == "p/sports/a/video.mp4"
    assert rows[5].asDict() == {
        "video_id": "f", "category": "Sports", "fine_category": "Fine", "video_key": "p/sports/f/video.mp4",
        "metadata_key": "p/sports/f/metadata.json", "channel": "channel", "title": "yt f.mp4", "upload_date": "20240129",
        "duration": 27, "resolution": "360x640", "shard": 2, "row_pos": 1,
    }


def test_manifest_of_what_is_new(spark, shards):
    stored = spark.createDataFrame([("a",), ("f",)], "video_id string")
    done = spark.createDataFrame([(1,)], "shard int")
    rows = ingest.build_manifest(shards, "Sports", "p", stored, done).collect()
    assert {r.video_id for r in rows} == {"shard00000_row000001", "c_d", "shard00002_row000000"}


def test_shards_that_are_done_are_not_opened_and_the_others_keep_their_numbers(spark, source, shards):
    files = shard_table(spark, shard_paths(spark, source))
    done = spark.createDataFrame([(0,), (0,), (7,)], "shard int")
    entries, rows = ingest.new_manifest(files, "Sports", "p", done, spark.createDataFrame([("f",)], "video_id string"))
    read = {f.rsplit("/", 1)[1] for f in entries.inputFiles()}
    assert read == {f.rsplit("/", 1)[1] for f in rows.inputFiles()} == {f"train-0000{i}-of-00003.parquet" for i in (1, 2)}
    whole = ingest.build_manifest(shards.filter("shard > 0"), "Sports", "p")
    assert sorted(entries.collect()) == sorted(whole.filter("video_id != 'f'").collect())
    assert "shard00002_row000000" in {r.video_id for r in entries.collect()}
    media = {r.video_id: bytes(r.mp4) for r in ingest.media_rows(rows, entries, "Sports").collect()}
    assert media["c_d"] == b"bytes of c_d.mp4" and set(media) == {r.video_id for r in entries.collect()}
    # Nothing left to read is a table without rows.
    every = spark.createDataFrame([(i,) for i in range(3)], "shard int")
    entries, rows = ingest.new_manifest(files, "Sports", "p", every)
    assert entries.isEmpty() and ingest.media_rows(rows, entries, "Sports").isEmpty()
    assert read_shard_table(files).columns == shards.columns


def test_counts_and_summary(shards):
    manifest = ingest.build_manifest(shards, "Sports", "p")
    counts = {r.shard: (r.n, r.running_total) for r in histogram.shard_counts(manifest).collect()}
    assert counts == {0: (3, 3), 1: (1, 4), 2: (2, 6), None: (6, 6)}
    assert ingest.summary(manifest, "Sports", "p", n_shards=3).first().asDict() == {
        "category": "Sports", "prefix": "p", "total_videos": 6, "n_shards": 3,
    }
    assert [r.video_id for r in ingest.capped(manifest, 2).collect()] == ["a", "shard00000_row000001"]


def test_histogram_keeps_null_and_orders_ties(shards):
    rows = histogram.value_counts(shards, "json.content_parent_category", "category").collect()
    assert [(r.category, r.n) for r in rows] == [("Sports", 7), (None, 1), ("Music", 1)]
    assert len(histogram.value_counts(shards, "json.content_parent_category", top=2).collect()) == 2


def test_preview(shards):
    rows = ingest.preview(shards, 5).collect()
    assert [(r.shard, r.row_pos) for r in rows] == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 0)]
    assert rows[0].title == "title a.mp4" and rows[0].youtube_title == "yt a.mp4"


def test_media_table_and_objects(spark, shards, tmp_path):
    manifest = ingest.build_manifest(shards, "Sports", "p")
    rows = ingest.media_rows(shards, manifest, "Sports")
    write_media(rows, str(tmp_path / "media"))
    stored = {r.video_id: r for r in spark.read.parquet(str(tmp_path / "media")).collect()}
    assert len(stored) == 6 and bytes(stored["c_d"].mp4) == b"bytes of c d.mp4"
    assert json.loads(stored["f"].metadata)["content_metadata"] == {"title": "title f.mp4"}
    folder = str(tmp_path)

    def put(key, data):
        with open(f"{folder}/{key}.bin", "wb") as f:
            f.write(data)

    export_objects(spark.read.parquet(str(tmp_path / "media")), "video_id", "mp4", put)
    assert (tmp_path / "a.bin").read_bytes() == b"bytes of a.mp4" and len(list(tmp_path.glob("*.bin"))) == 6


def test_manifest_files(spark, shards, tmp_path):
    manifest = ingest.build_manifest(shards, "Sports", "p")
    write_jsonl(manifest, str(tmp_path / "manifest.jsonl"))
    lines = read_lines(spark, str(tmp_path / "manifest.jsonl"), "*.json").collect()
    assert {json.loads(r.raw)["video_id"] for r in lines} == {r.video_id for r in manifest.collect()}
    write_summary(ingest.summary(manifest, "Sports", "p"), str(tmp_path / "summary"))
    assert [json.loads(r.raw)["total_videos"] for r in read_lines(spark, str(tmp_path / "summary"), "*.json").collect()] == [6]


def test_frame_plan_equals_the_recorded_one(spark):
    manifest = spark.createDataFrame([("09buIj5Z5lk", 62.4, "640x360")], "video_id string, duration double, resolution string")
    plan = frame_plans.frame_plan(manifest, "media/sports").first()
    assert plan.num_frames == 16 and plan.sampling == "uniform" and plan.frame_size == "448x448"
    assert plan.source_duration == 62 and plan.sampling_config_hash == "d587a6"
    assert plan.frames == [f"media/sports/09buIj5Z5lk/frames/frame_{i:03d}.jpg" for i in range(1, 17)]


def test_frames_are_gathered_in_listed_order(spark, shards, tmp_path):
    manifest = ingest.build_manifest(shards, "Sports", "p")
    plan = frame_plans.frame_plan(manifest, "p", 3)
    for row in plan.collect():
        for key in row.frames[: 2 if row.video_id == "a" else 3]:
            path = tmp_path / "store" / key
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(f"jpeg {key}".encode())
        fields = {k: v for k, v in row.asDict().items() if k in frame_plans.FRAMES_JSON}
        (tmp_path / "store" / "p" / row.video_id / "frames" / "frames.json").write_text(json.dumps(fields, indent=2))
    stored = read_frames(spark, str(tmp_path / "store"))
    assert stored.count() == 6
    objects = read_frame_bytes(spark, str(tmp_path / "store"))
    for row in gather_frames(stored, objects).collect():
        contents = [None if c is None else bytes(c).decode() for c in row.contents]
        wanted = [f"jpeg p/{row.video_id}/frames/frame_{i:03d}.jpg" for i in (1, 2, 3)]
        assert contents == ([*wanted[:2], None] if row.video_id == "a" else wanted)
        assert row.n_missing == (1 if row.video_id == "a" else 0)


def test_frames_lines(spark, shards, tmp_path):
    plan = frame_plans.frame_plan(ingest.build_manifest(shards, "Sports", "p"), "p").select(*frame_plans.FRAMES_JSON)
    write_frames(plan, str(tmp_path / "frames"))
    rows = [json.loads(r.raw) for r in read_lines(spark, str(tmp_path / "frames"), "*.txt").collect()]
    assert len(rows) == 6 and all(len(r["frames"]) == 16 and list(r) == frame_plans.FRAMES_JSON for r in rows)


def test_result_log_is_appended_per_shard(spark, tmp_path):
    rows = spark.createDataFrame([(0, "a", "x"), (1, "b", "y")], "shard int, id string, output string")
    write_shard_log(rows, str(tmp_path / "shards"))
    write_shard_log(rows.filter("shard = 1"), str(tmp_path / "shards"))
    assert sorted(r.raw for r in read_lines(spark, str(tmp_path / "shards"), "*.json").collect()) == [
        '{"id":"a","output":"x"}', '{"id":"b","output":"y"}', '{"id":"b","output":"y"}',
    ]


def test_a_repeated_run_replaces_and_a_new_prompt_adds(spark, tmp_path):
    schema = "video_id string, run_id string, answer string, created_at timestamp"

    def write(*rows):
        df = spark.createDataFrame([(v, r, a, None) for v, r, a, _ in rows], schema)
        df = df.withColumn("created_at", F.lit(rows[0][3]).cast("timestamp"))
        write_single_results(df, str(tmp_path / "results"))

    write(("v", "0042", "old", "2026-01-01 00:00:00"), ("w", "0042", "kept", "2026-01-01 00:00:00"))
    write(("v", "0042", "new", "2026-01-02 00:00:00"), ("v", "77e1", "other", "2026-01-02 00:00:00"))
    rows = current_results(spark, str(tmp_path / "results")).collect()
    assert {(r.video_id, r.run_id): r.answer for r in rows} == {
        ("v", "0042"): "new", ("w", "0042"): "kept", ("v", "77e1"): "other",
    }


def test_result_objects(spark, tmp_path):
    result = {
        "video_id": "v", "model": "m", "prompt": "p", "answer": "a", "run_id": "042dd539417d",
        "created_at": "2026-07-24T03:50:22.388737+00:00",
        "sampling_params": {"temperature": 0.2, "top_p": 0.9, "max_tokens": 512},
        "frames_ref": {"num_frames": 16, "frame_size": "448x448", "sampling": "uniform", "sampling_config_hash": "d587a6"},
    }
    path = tmp_path / "v" / "inference"
    path.mkdir(parents=True)
    (path / "042dd539417d.json").write_text(json.dumps(result, indent=2))
    row = read_results(spark, str(tmp_path)).first()
    assert row.run_id == "042dd539417d" and row.created_at.microsecond == 388737 and row.frames_ref.num_frames == 16


def test_a_name_of_a_done_shard_is_taken_from_its_new_one(spark):
    from framelark.plans.ingest import build_manifest

    schema = (
        "shard bigint, row_pos bigint, json struct<content_parent_category: string, content_fine_category: string, "
        "original_video_filename: string, youtube_channel: string, youtube_title: string, youtube_upload_date: string, "
        "duration_seconds: double, resolution: string>"
    )
    rows = [(s, p, ("c", "f", name, "ch", "t", "20200101", 8.9, "1x1")) for s, p, name in ((0, 0, "a.mp4"), (1, 0, "a.mp4"), (1, 1, "b.mp4"))]
    shards = spark.createDataFrame(rows, schema)
    done = spark.createDataFrame([(0,)], "shard bigint")
    found = build_manifest(shards, "c", "p", None, done).collect()
    assert sorted((r.video_id, r.shard) for r in found) == [("a", 1), ("b", 1)]


def test_videos_without_frames_stay(spark):
    from framelark.operators.gather import gather_frames

    frames = spark.createDataFrame([("a", []), ("b", None), ("c", ["k", "gone"])], "video_id string, frames array<string>")
    objects = spark.createDataFrame([("k", "bytes")], "key string, content string")
    found = {r.video_id: (r.contents, r.n_missing) for r in gather_frames(frames, objects).collect()}
    assert found == {"a": ([], 0), "b": ([], 0), "c": (["bytes", None], 1)}


def test_fractional_seconds_from_shard_to_frame_plan(spark, tmp_path):
    rows = [video("a.mp4", duration=62.5), video("b.mp4", duration=0.75), video("c.mp4", duration=None)]
    schema = SHARD_ROW.replace("duration_seconds: bigint", "duration_seconds: double")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "train-0"))
    (path,) = [str(p) for p in (tmp_path / "train-0").glob("part-*.parquet")]
    shards = read_shards(spark, [path])
    manifest = ingest.build_manifest(shards, "Sports", "p")
    assert {r.video_id: r.duration for r in manifest.collect()} == {"a": 62.5, "b": 0.75, "c": None}
    write_jsonl(manifest.drop("shard", "row_pos"), str(tmp_path / "manifest"))
    again = parse_strict(read_lines(spark, str(tmp_path / "manifest"), "*.json"), MANIFEST)
    plan = {r.video_id: r for r in frame_plans.frame_plan(again, "p", 16).collect()}
    assert (plan["a"].source_duration, plan["a"].fps, plan["a"].times[1]) == (62, 0.256, 62.5 / 16)
    assert (plan["b"].source_duration, plan["b"].fps, plan["b"].times[15]) == (1, 21.333333, 0.75 * 15 / 16)
    assert plan["c"].source_duration is None and plan["c"].fps is None
