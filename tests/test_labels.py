"""Label checks, comparisons, training rows and caching."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from framelark.functions import cache_key, stage_key
from framelark.operators import labels
from framelark.operators.pending import cache_pending
from framelark.plans import training

GOOD = {
    "scene": "s", "actions": ["a", "b"], "objects": ["x", "y"], "camera": "c", "summary": "t",
    "qa": [{"q": "1", "a": "1"}, {"q": "2", "a": "2"}, {"q": "3", "a": "3"}], "confidence": "high",
}


def broken_rules(spark, answer):
    text = answer if isinstance(answer, str) else json.dumps(answer)
    row = labels.validated(spark.createDataFrame([(text,)], "answer string")).first()
    assert row.valid == all(v for k, v in row.asDict().items() if k.startswith("ok_"))
    return {k for k, v in row.asDict().items() if k.startswith("ok_") and not v}


def test_each_rule(spark):
    assert broken_rules(spark, GOOD) == set()
    assert broken_rules(spark, GOOD | {"actions": [], "qa": [], "confidence": "low"}) == set()
    assert broken_rules(spark, GOOD | {"actions": list("abcdef")}) == {"ok_actions"}
    assert broken_rules(spark, GOOD | {"actions": "a"}) == {"ok_actions"}
    assert broken_rules(spark, GOOD | {"objects": ["x", "x"]}) == {"ok_objects"}
    assert broken_rules(spark, GOOD | {"objects": list("abcdefghijk")}) == {"ok_objects"}
    assert broken_rules(spark, GOOD | {"qa": []}) == {"ok_qa"}
    assert broken_rules(spark, GOOD | {"qa": GOOD["qa"][:2]}) == {"ok_qa"}
    assert broken_rules(spark, GOOD | {"qa": [*GOOD["qa"][:2], {"q": "3"}]}) == {"ok_qa_fields"}
    assert broken_rules(spark, GOOD | {"confidence": "sure"}) == {"ok_confidence"}
    assert broken_rules(spark, {k: v for k, v in GOOD.items() if k != "scene"}) == {"ok_text"}
    assert "ok_no_fence" in broken_rules(spark, f"```json\n{json.dumps(GOOD)}\n```")
    for text in ("no json", json.dumps(GOOD)[:-1], json.dumps(GOOD) + " and more", "[]", ""):
        assert "ok_json" in broken_rules(spark, text)


def test_quality_per_prompt_version(spark):
    rows = [("v1", json.dumps(GOOD)), ("v1", "broken"), ("v2", json.dumps(GOOD | {"qa": []}))]
    found = labels.label_quality(spark.createDataFrame(rows, "version string, answer string"), "version").collect()
    assert {r.version: (r.n_answers, r.parse_rate, r.valid_rate) for r in found} == {"v1": (2, 0.5, 0.5), "v2": (1, 1.0, 0.0)}


def test_repetition_and_language(spark):
    texts = spark.createDataFrame([("a b a b a b",), ("",), ("한국어 english",)], "t string")
    rows = {r.t: r for r in labels.repetition(texts, "t").collect()}
    assert (rows["a b a b a b"].n_ngrams, rows["a b a b a b"].n_repeated) == (5, 3)
    assert rows[""].repetition_rate == 0.0
    rows = {r.t: r for r in labels.language_compliance(texts, "t", r"\p{IsHangul}").collect()}
    assert rows["한국어 english"].script_share == 0.3 and not rows["한국어 english"].compliant
    assert rows[""].script_share == 0.0


def test_field_agreement_counts_nulls_as_equal(spark):
    left = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y")], "k int, f string, g string")
    right = spark.createDataFrame([(1, "a", None), (2, "z", "x"), (9, "c", "y")], "k int, f string, g string")
    row = labels.field_agreement(left, right, ["k"], ["f", "g"]).first()
    assert (row.n_pairs, row.agreement_f, row.agreement_g) == (2, 0.5, 1.0)


def test_newest_label_and_changes(spark):
    rows = [("v", 1, "a"), ("v", 2, "a"), ("v", 3, "b"), ("w", 1, "z")]
    results = spark.createDataFrame(rows, "video_id string, at int, answer string")
    assert {r.video_id: r.answer for r in labels.latest_label(results, ["at"]).collect()} == {"v": "b", "w": "z"}
    for parts in (1, 3, None):
        found = labels.label_changes(results, ["at"], parts=parts).collect()
        assert {(r.video_id, r.at): (r.previous_answer, r.changed) for r in found} == {
            ("v", 1): (None, False), ("v", 2): ("a", False), ("v", 3): ("a", True), ("w", 1): (None, False),
        }


def test_only_what_changed_is_computed_again(spark):
    def keyed(rows):
        df = spark.createDataFrame(rows, "video_id string, prompt string, sampling string")
        return df.withColumns(
            {
                "cache_key": cache_key("video_id", "sampling", "prompt", F.lit("m"), F.lit("t")),
                "frames_key": stage_key(video_id="video_id", sampling="sampling"),
            }
        )

    cached = keyed([("v", "p1", "16"), ("w", "p1", "16")])
    wanted = keyed([("v", "p1", "16"), ("v", "p2", "16"), ("w", "p1", "32"), ("x", "p1", "16")])
    found = {(r.video_id, r.prompt, r.sampling): r.frames_cached for r in cache_pending(wanted, cached).collect()}
    assert found == {("v", "p2", "16"): True, ("w", "p1", "32"): False, ("x", "p1", "16"): False}


def test_dev_subset_is_fixed_and_mixed(spark):
    videos = spark.range(400).select(F.col("id").cast("string").alias("video_id"), (F.col("id") % 4).alias("stratum"))
    chosen = {r.video_id for r in labels.dev_subset(videos, ["stratum"], 6).collect()}
    assert len(chosen) == 24
    assert chosen == {r.video_id for r in labels.dev_subset(videos.repartition(9), ["stratum"], 6).collect()}


def test_token_budget(spark):
    rows = labels.token_budget(spark.createDataFrame([(49152,), (4096,), (8192,), (0,)], "image_tokens bigint"), (8192, 16384))
    found = {r.image_tokens: (r.fits_8192, r.per_batch_8192, r.per_batch_16384) for r in rows.collect()}
    assert found == {49152: (False, 0, 0), 4096: (True, 2, 4), 8192: (False, 1, 2), 0: (True, None, None)}


def test_training_rows_take_the_newest_answer(spark):
    manifest = spark.createDataFrame([("v", "c", "f"), ("w", "c", "f")], "video_id string, category string, fine_category string")
    frames = spark.createDataFrame([("v", ["1.jpg", "2.jpg"], 2)], "video_id string, frames array<string>, num_frames int")
    results = spark.createDataFrame(
        [("v", "p1", "old", 1), ("v", "p2", "new", 2), ("w", "p1", "x", 1)], "video_id string, prompt string, answer string, at int"
    )
    rows = training.training_rows(manifest, frames, results, ["at"]).collect()
    assert len(rows) == 1 and rows[0].target == "new"
    assert [tuple(m) for m in rows[0].messages] == [("user", "Frame1: <image>\nFrame2: <image>\np2")]


def test_comparison_of_two_models(spark):
    schema = "video_id string, probe string, at int, answer string"
    teacher = spark.createDataFrame([("v", "sport", 1, "old"), ("v", "sport", 2, "크리켓"), ("v", "action", 1, "뛴다")], schema)
    student = spark.createDataFrame([("v", "sport", 1, "크리켓"), ("v", "action", 1, "run run run"), ("w", "sport", 1, "x")], schema)
    pairs = training.paired_answers(teacher, student, ["at"])
    report = {r.probe: r for r in training.comparison_report(pairs, r"\p{IsHangul}").collect()}
    assert report["sport"].agreement == 1.0 and report["sport"].student_script_share == 1.0
    assert report["action"].agreement == 0.0 and report["action"].student_script_share == 0.0
    assert report["action"].student_repetition == 0.5


def wanted_seats(counts, total):
    """Largest remainders, as a plain loop."""
    n = sum(counts.values())
    total = min(total, n)
    seats = {s: total * c // n for s, c in counts.items()}
    rest = sorted(counts, key=lambda s: (-(total * counts[s] % n), s[0] is None, s[0] or "", s[1] is None, s[1] or 0))
    for s in rest[: total - sum(seats.values())]:
        seats[s] += 1
    return {s: k for s, k in seats.items() if k}


def strata_of(df):
    found = {}
    for r in df.collect():
        found.setdefault((r.category, r.length), []).append((r.rank, r.video_id))
    return {s: [v for _, v in sorted(rows)] for s, rows in found.items()}


@pytest.mark.parametrize("total", [1, 7, 20, 50, 5000])
def test_dev_subset_of_a_fixed_size(spark, total):
    rng = random.Random(total)
    rows = [(f"v{i}", rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([1, 1, 2, None])) for i in range(400)]
    schema = "video_id string, category string, length int"
    videos = spark.createDataFrame(rows, schema)
    counts = {}
    for _, c, n in rows:
        counts[(c, n)] = counts.get((c, n), 0) + 1
    found = strata_of(labels.dev_subset(videos, ["category", "length"], total=total))
    seats = wanted_seats(counts, total)
    assert {s: len(v) for s, v in found.items()} == seats and sum(seats.values()) == min(total, 400)
    assert all(abs(seats.get(s, 0) - min(total, 400) * c / 400) < 1 for s, c in counts.items())
    assert found == strata_of(labels.dev_subset(videos.repartition(7), ["category", "length"], total=total))
    # Videos that are added move in among the others; those that stay keep their order.
    more = videos.unionByName(spark.createDataFrame([(f"w{i}", "a", 1) for i in range(60)], schema))
    later = strata_of(labels.dev_subset(more, ["category", "length"], total=total))
    for s, chosen in later.items():
        old = [v for v in chosen if v.startswith("v")]
        assert old == found.get(s, [])[: len(old)] or found.get(s, []) == old[: len(found.get(s, []))]


def test_dev_subset_of_nothing(spark):
    videos = spark.createDataFrame([], "video_id string, category string")
    assert labels.dev_subset(videos, ["category"], total=20).collect() == []
    for wrong in ({}, {"total": 3, "per_stratum": 2}):
        with pytest.raises(ValueError, match="either"):
            labels.dev_subset(videos, ["category"], **wrong)


def longest_by_hand(text):
    w = (text or "").split()
    for n in range(len(w) - 1, 0, -1):
        seen = {}
        for p in range(len(w) - n + 1):
            seen.setdefault(tuple(w[p : p + n]), []).append(p)
        again = [places for places in seen.values() if len(places) > 1]
        if again:
            places = min(again)
            return n, len(places), " ".join(w[places[0] : places[0] + n])
    return 0, 0, None


def test_longest_phrase_said_twice(spark):
    rng = random.Random(6)
    texts = [None, "", " ", "a", "a a", "a b", "a b a b a", "x " * 40, "no word twice here"]
    texts += [" ".join(rng.choice("abcdefgh"[: rng.randint(1, 8)]) for _ in range(rng.randint(1, 70))) for _ in range(150)]
    for k in (1, 2, 3, 7, 8, 9, 31, 33):
        phrase = " ".join(f"p{i}" for i in range(k))
        texts.append(" ".join([phrase, "one two", phrase, "three", phrase]))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r.i: (r.phrase_words, r.phrase_times, r.phrase) for r in labels.longest_phrases(df, "t").collect()}
    assert found == {i: longest_by_hand(t) for i, t in enumerate(texts)}


def test_longest_phrase_takes_time_near_linear_in_the_text(spark):
    def seconds(n):
        rng = random.Random(n)
        half = [f"w{rng.randrange(n)}" for _ in range(n // 2)]
        df = spark.createDataFrame([(" ".join(half + ["|"] + half),)], "t string")
        start = time.perf_counter()
        (row,) = labels.longest_phrases(df, "t").collect()
        assert (row.phrase_words, row.phrase_times) == (n // 2, 2)
        return time.perf_counter() - start

    seconds(2_000)
    assert seconds(64_000) < 40 * max(seconds(4_000), 0.2)


def test_quality_per_prompt_version_with_the_labels_that_were_wanted(spark):
    said = GOOD | {"summary": "a b a b", "camera": "x"}
    rows = [
        ("v1", json.dumps(said), json.dumps(GOOD)),
        ("v1", json.dumps(GOOD), json.dumps(GOOD)),
        ("v1", "broken", json.dumps(GOOD)),
        ("v1", json.dumps(said), None),
        ("v2", "broken", json.dumps(GOOD)),
    ]
    df = spark.createDataFrame(rows, "version string, answer string, gold string")
    found = {r.version: r for r in labels.label_quality(df, "version", gold="gold", told="summary").collect()}
    one = found["v1"]
    assert (one.n_answers, one.n_parsed, one.n_compared) == (4, 3, 2)
    assert (one.agreement_scene, one.agreement_camera, one.agreement_confidence) == (1.0, 0.5, 1.0)
    # "a b a b" twice: three bigrams of which one repeats; "t" has none.
    assert one.repetition_rate == pytest.approx(2 / 6)
    assert (found["v2"].n_compared, found["v2"].agreement_scene, found["v2"].repetition_rate) == (0, None, 0.0)
    plan = labels.label_quality(df, "version", gold="gold", told="summary")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_training_rows_of_planned_videos_need_one_join(spark):
    from framelark.plans import frames

    manifest = spark.createDataFrame([("v", "c", "f", 32, "640x360"), ("w", "c", "f", 3, "640x360")], "video_id string, category string, fine_category string, duration bigint, resolution string")
    results = spark.createDataFrame([("v", "p1", "old", 1), ("v", "p2", "new", 2)], "video_id string, prompt string, answer string, at int")
    found = training.planned_training_rows(frames.with_frame_plan(manifest, "p", 2), results, ["at"])
    (row,) = found.collect()
    assert row.target == "new" and row.frames == ["p/v/frames/frame_001.jpg", "p/v/frames/frame_002.jpg"]
    apart = training.training_rows(manifest, frames.frame_plan(manifest, "p", 2), results, ["at"]).collect()
    assert apart == [row]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Join") == 1 and plan.count("Scan ExistingRDD") == 2
