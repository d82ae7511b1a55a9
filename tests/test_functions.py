"""Column functions against values known in advance."""

import json

import pytest
from pyspark.sql import functions as F

from framelark import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "name, expected",
    [
        ("a/b/_Ab-1.mp4", "Ab-1"),
        ("x.tar.gz", "x_tar"),
        (".mp4", "mp4"),
        ("..mp4", "mp4"),
        ("..a.mp4", "a"),
        ("한글.mp4", "shard00003_row000007"),
        (None, "shard00003_row000007"),
        ("dir/", "shard00003_row000007"),
        ("G_VTkkb34gw.mp4", "G_VTkkb34gw"),
    ],
)
def test_safe_id(spark, name, expected):
    assert one(spark, fn.safe_id(F.lit(name).cast("string"), F.lit(3), F.lit(7))) == expected


def test_hashes_equal_the_recorded_ones(spark):
    # A prompt and a model path with the run id they were stored under.
    assert one(spark, fn.config_hash(16)) == "d587a6"
    run = fn.run_id(F.lit("이 영상을 한국어로 설명해줘."), F.lit("/models/internvl3-78b"), fn.config_hash(16))
    assert one(spark, run) == "042dd539417d"


def test_missing_hash_part_is_spelled_out(spark):
    missing = fn.run_id(F.lit("p"), F.lit("m"), F.lit(None).cast("string"))
    spelled = fn.run_id(F.lit("p"), F.lit("m"), F.lit("None"))
    assert one(spark, missing) == one(spark, spelled)


def test_cache_key_depends_on_every_part(spark):
    parts = ["v", "s", "p", "m", "d"]
    keys = {one(spark, fn.cache_key(*[F.lit(x) for x in parts]))}
    for i in range(5):
        changed = [*parts[:i], "other", *parts[i + 1 :]]
        keys.add(one(spark, fn.cache_key(*[F.lit(x) for x in changed])))
    assert len(keys) == 6


def test_rate_is_cut_not_rounded(spark):
    assert one(spark, fn.sampling_fps(F.lit(282))) == 0.056737
    assert one(spark, fn.sampling_fps(F.lit("268.440000"))) == 0.059603
    assert one(spark, fn.sampling_fps(F.lit(0))) is None


def test_duration_halves_go_to_even(spark):
    assert [one(spark, fn.duration_seconds_int(F.lit(x))) for x in (62.5, 63.5, 268.44)] == [62, 64, 268]


def test_frame_keys_and_times(spark):
    keys = one(spark, fn.frame_keys("media/sports", F.lit("09buIj5Z5lk")))
    assert keys[0] == "media/sports/09buIj5Z5lk/frames/frame_001.jpg"
    assert keys[-1] == "media/sports/09buIj5Z5lk/frames/frame_016.jpg"
    assert keys == sorted(keys) and len(keys) == 16
    times = one(spark, fn.frame_times(F.lit(32), 16))
    assert times == [2.0 * k for k in range(16)]


@pytest.mark.parametrize(
    "resolution, expected",
    [("640x360", (448, 252, 0, 98)), ("360x640", (252, 448, 98, 0)), ("448x448", (448, 448, 0, 0)), ("400x226", (448, 253, 0, 97))],
)
def test_letterbox(spark, resolution, expected):
    assert tuple(one(spark, fn.letterbox(F.lit(resolution)))) == expected


def test_token_estimate(spark):
    assert one(spark, fn.image_tokens(F.lit(16), 12)) == 49152
    assert one(spark, fn.image_tokens(F.lit(16))) == 4096


def test_prompts(spark):
    assert one(spark, fn.video_prompt(F.lit(2), F.lit("p"))) == "Frame1: <image>\nFrame2: <image>\np"
    assert one(spark, fn.video_prompt(F.lit(0), F.lit("p"))) == "\np"
    assert one(spark, fn.batch_prompt(F.lit(0), F.lit("p"))) == "p"
    assert one(spark, fn.batch_prompt(F.lit(1), F.lit("p"))) == "<image>\np"
    assert one(spark, fn.batch_prompt(F.lit(2), F.lit("p"))) == "Image-1: <image>\nImage-2: <image>\np"


def test_chat_messages(spark):
    def shown(system):
        return [tuple(m) for m in one(spark, fn.chat_messages(F.lit("u"), system))]

    assert shown(F.lit("s")) == [("system", "s"), ("user", "u")]
    assert shown(F.lit("")) == shown(F.lit(None).cast("string")) == shown(None) == [("user", "u")]


def test_template(spark):
    filled = fn.fill_template(
        "{{N_FRAMES}}/{{FRAME_INTERVAL}}/{{DOMAIN_HINT}}/{{TARGET_CLASSES}}", F.lit(8), F.lit("0.5"), F.lit("shop"), F.lit("")
    )
    assert one(spark, filled) == "8/0.5/shop/없음"


@pytest.mark.parametrize(
    "reference, expected",
    [
        ("s3://b/k/x.jpg", ("s3", "b", "k/x.jpg")),
        ("s3://b", ("s3", "b", "")),
        ("https://h/x.jpg", ("https", None, "https://h/x.jpg")),
        ("http://h/x.jpg", ("http", None, "http://h/x.jpg")),
        ("rel/x", ("s3", "own", "in/images/rel/x")),
        ("//rel/x", ("s3", "own", "in/images/rel/x")),
    ],
)
def test_resolve_uri(spark, reference, expected):
    assert tuple(one(spark, fn.resolve_uri(F.lit(reference), "own", "in/images//"))) == expected


def test_resolve_uri_without_prefix_keeps_the_reference(spark):
    assert tuple(one(spark, fn.resolve_uri(F.lit("/rel/x"), "own"))) == ("s3", "own", "/rel/x")


def test_defaults(spark):
    assert one(spark, fn.first_nonempty(F.lit(""), F.lit("d"))) == "d"
    assert one(spark, fn.first_nonempty(F.lit(None).cast("string"), F.lit("d"))) == "d"
    empty, none = F.array().cast("array<string>"), F.lit(None)
    assert one(spark, fn.image_list(empty, F.lit("i"))) == ["i"]
    assert one(spark, fn.image_list(none.cast("array<string>"), none.cast("string"))) == []
    assert one(spark, fn.image_list(F.array(F.lit("a"), F.lit("b")), F.lit("i"))) == ["a", "b"]


def test_strip_is_that_of_python(spark):
    for text in ("　 a b \x1c\n", " x ", " ", "", "a　b", "\x1fx\x1d"):
        assert one(spark, fn.strip(F.lit(text))) == text.strip()


def test_ngrams(spark):
    words = fn.words(F.lit(" a b\ta\nb c "))
    assert one(spark, words) == ["a", "b", "a", "b", "c"]
    assert one(spark, fn.ngrams(words)) == ["a b", "b a", "a b", "b c"]
    assert one(spark, fn.repeated_count(fn.ngrams(words))) == 1
    assert one(spark, fn.ngrams(words, 3)) == ["a b a", "b a b", "a b c"]
    assert one(spark, fn.ngrams(fn.words(F.lit("a")))) == []
    assert one(spark, fn.ngrams(fn.words(F.lit("")))) == []


def test_script_counts(spark):
    text = fn.letters(F.lit("한국어 abc é 12"))
    assert one(spark, fn.letter_count(text)) == 7
    assert one(spark, fn.script_count(text)) == 3
    assert one(spark, fn.script_count(text, "A-Za-z")) == 3


def test_shard_file(spark):
    assert one(spark, fn.shard_file(F.lit(3))) == "shard-00003.jsonl"
    assert one(spark, fn.result_key("p", F.lit("v"), F.lit("r"))) == "p/v/inference/r.json"


def test_json_keeps_non_ascii(spark):
    text = one(spark, F.to_json(F.struct(F.lit("한글").alias("t"))))
    assert text == json.dumps({"t": "한글"}, ensure_ascii=False).replace(": ", ":")


def test_repeated_keys_fractions_and_unicode_words(spark):
    from framelark.functions import frame_interval, words
    from framelark.functions.json import with_json_fields

    raw = spark.createDataFrame([('{"id":"a","x":1,"id":"b","id":"c"}',), ('{"id":"z"}',), ("{}",)], "raw string")
    assert [r.fields for r in with_json_fields(raw, "raw").collect()] == [{"x": "1", "id": "c"}, {"id": "z"}, {}]
    durations = spark.createDataFrame([(8.9,), (62.0,)], "d double")
    assert [r.i for r in durations.select(frame_interval("d", 16).alias("i")).collect()] == ["0.6", "3.9"]
    korean = spark.createDataFrame([("가　가 나",)], "t string")
    assert korean.select(words("t").alias("w")).first().w == ["가", "가", "나"]
