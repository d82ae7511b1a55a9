"""The batch scorer: batches, errors, who gets which answer."""

import pytest

from pyspark.sql import functions as F

from framelark.operators.pending import resume_pending
from framelark.operators.scoring import score, scoring_input
from framelark.plans import labelling, results
from framelark.plans.frames import frame_plan
from framelark.schemas import BATCH_PROMPT, INFERENCE_MANIFEST, PROBES


def records(spark, n, parts=1):
    rows = [(f"r{i}", f"say {i}", None, [f"img/{i}/{k}" for k in range(i % 3)]) for i in range(n)]
    return scoring_input(spark.createDataFrame(rows, INFERENCE_MANIFEST).coalesce(parts))


def echo_model():
    def make():
        def generate(batch):
            return [f" {item['prompt']}|{len(item['images'])}|{len(batch)} \n" for item in batch]

        return generate

    return make


def keep(reference):
    return reference


def test_batches_are_full_across_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rows = score(records(spark, 200), echo_model(), keep, "m", batch_size=48).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sizes = [r.output.split("|")[2] for r in sorted(rows, key=lambda r: int(r.id[1:]))]
    assert sizes == ["48"] * 192 + ["8"] * 8
    assert all(r.output.startswith(f"say {r.id[1:]}|{int(r.id[1:]) % 3}|") and r.model == "m" for r in rows)


def test_a_failed_load_costs_only_its_own_record(spark):
    def load(reference):
        if reference in ("img/4/0", "img/8/1"):
            raise OSError(f"no {reference}")
        return reference

    rows = {r.id: r for r in score(records(spark, 12), echo_model(), load, "m").collect()}
    assert len(rows) == 12
    assert rows["r4"].error == "image_load: no img/4/0" and rows["r4"].prompt == "say 4" and rows["r4"].output is None
    assert rows["r8"].error == "image_load: no img/8/1"
    for i in set(range(12)) - {4, 8}:
        assert rows[f"r{i}"].output == f"say {i}|{i % 3}|10" and rows[f"r{i}"].error is None


def test_a_failed_batch_gives_each_of_its_records_an_error(spark):
    def make():
        def generate(batch):
            if any(item["prompt"] == "say 5" for item in batch):
                raise RuntimeError("out of memory")
            return ["ok"] * len(batch)

        return generate

    rows = {r.id: r for r in score(records(spark, 12), make, keep, "m", batch_size=4).collect()}
    failed = {i for i in range(12) if rows[f"r{i}"].error == "generate: out of memory"}
    assert failed == {4, 5, 6, 7}
    assert all(rows[f"r{i}"].prompt is None for i in failed)
    assert all(rows[f"r{i}"].output == "ok" for i in set(range(12)) - failed)


def test_the_model_is_made_only_if_there_is_work(spark):
    def make():
        raise RuntimeError("loaded")

    nothing = records(spark, 3).filter("id = 'none'")
    assert score(nothing, make, keep, "m").count() == 0
    with pytest.raises(Exception, match="loaded"):
        score(records(spark, 3), make, keep, "m").collect()


def test_too_many_images_is_an_error_of_the_record(spark):
    rows = {r.id: r for r in score(records(spark, 3), echo_model(), keep, "m", max_images=1).collect()}
    assert rows["r2"].error == "image_load: 2 images, at most 1 allowed" and rows["r1"].error is None


def test_spread_over_partitions(spark):
    rows = score(records(spark, 100), echo_model(), keep, "m", partitions=5, keep_model_as="echo").collect()
    assert {r.id for r in rows} == {f"r{i}" for i in range(100)}


def test_defaults_are_filled_in(spark):
    rows = [("a", "", "one.jpg", None), ("b", None, None, []), ("c", "p", "x.jpg", ["1.jpg", "2.jpg"])]
    found = scoring_input(spark.createDataFrame(rows, INFERENCE_MANIFEST), system_prompt="sys")
    shown = {r.id: (r.prompt, r.images, [tuple(m) for m in r.messages]) for r in found.collect()}
    assert shown["a"] == (BATCH_PROMPT, ["one.jpg"], [("system", "sys"), ("user", f"<image>\n{BATCH_PROMPT}")])
    assert shown["b"][:2] == (BATCH_PROMPT, [])
    assert shown["c"][2][1] == ("user", "Image-1: <image>\nImage-2: <image>\np")


def test_shared_images_are_loaded_once_per_batch(spark, tmp_path):
    frames = spark.createDataFrame([(v, [f"{v}/1.jpg", f"{v}/2.jpg"]) for v in "abc"], "video_id string, frames array<string>")
    folder = str(tmp_path)

    def load(reference):
        with open(f"{folder}/{reference.replace('/', '-')}", "a") as f:
            f.write("x")
        return reference

    probes = labelling.probe_records(frames)
    rows = score(probes, echo_model(), load, "m", partitions=2, spread_by=labelling.video_of_probe())
    answers = labelling.probe_answers(rows).collect()
    assert {(r.video_id, r.probe) for r in answers} == {(v, k) for v in "abc" for k, _ in PROBES}
    assert [p.read_text() for p in sorted(tmp_path.iterdir())] == ["x"] * 6


def test_labelled_videos(spark):
    manifest = spark.createDataFrame([("v", 62, "640x360"), ("w", 30, "640x360")], "video_id string, duration int, resolution string")

    def load(reference):
        if "/w/" in reference:
            raise OSError("gone")
        return reference

    found, failed = labelling.labelled_videos(frame_plan(manifest, "p"), "이 영상을 한국어로 설명해줘.", echo_model(), load, "/models/internvl3-78b")
    row = found.first()
    assert found.count() == 1 and row.video_id == "v" and row.run_id == "042dd539417d"
    assert row.frames_ref.sampling_config_hash == "d587a6" and row.sampling_params.max_tokens == 512
    assert [(r.id, r.error) for r in failed.collect()] == [("w", "image_load: gone")]


def test_resuming_after_a_cut_equals_one_run(spark):
    def load(reference):
        if reference == "img/4/0":
            raise OSError("gone")
        return reference

    rows = [(f"r{i}", f"say {i}", None, [f"img/{i}/0"] * (i % 2 + 1)) for i in range(20)]
    manifest = spark.createDataFrame(rows, INFERENCE_MANIFEST)

    def run(pending):
        return score(scoring_input(pending), echo_model(), load, "m", batch_size=5)

    def shown(scored):
        return {(r.id, r.prompt, (r.output or "").split("|")[0], r.error) for r in scored.collect()}

    whole = shown(run(manifest))
    for cut in (0, 7, 20):
        first = run(manifest.filter(F.substring("id", 2, 9).cast("int") < cut))
        lines = first.select(F.to_json(F.struct(*first.columns)).alias("raw"))
        rest = resume_pending(manifest, results.classified(lines))
        assert rest.count() == 20 - cut
        assert shown(first) | shown(run(rest)) == whole


def test_a_null_answer_is_an_error_of_its_batch(spark):
    records = spark.createDataFrame([("a", "p", [], [("user", "x")])], "id string, prompt string, images array<string>, messages array<struct<role: string, content: string>>")
    found = score(records, lambda: lambda batch: [None], str, "m").collect()
    assert len(found) == 1 and found[0].error.startswith("generate: ") and found[0].output is None


def test_every_video_is_scored_once(spark, tmp_path):
    from framelark.plans.labelling import labelled_videos

    calls = str(tmp_path / "calls")
    frames = spark.createDataFrame(
        [(f"v{i}", 16, "448x448", "uniform", "h", [f"f{i}"]) for i in range(10)],
        "video_id string, num_frames int, frame_size string, sampling string, sampling_config_hash string, frames array<string>",
    )

    def make():
        def generate(batch):
            with open(calls, "a") as out:
                out.write("x" * len(batch))
            return [item["prompt"] for item in batch]

        return generate

    answered, failed = labelled_videos(frames, "p", make, str, "m")
    assert (answered.count(), failed.count(), answered.select("frames_ref.num_frames").distinct().count()) == (10, 0, 1)
    assert len((tmp_path / "calls").read_text()) == 10
