"""Frame plans in a store are found by its indexes; nothing lists their folders for the driver."""

import json

from pyspark.sql import functions as F

from framelark.queries import catalog
from framelark.sinks.objects import published, write_objects
from framelark.sources import read_frames


def plans_of(spark, n, parts=3):
    fields = F.struct(F.concat(F.lit("v"), "id").alias("video_id"), F.col("id").cast("int").alias("num_frames"))
    key = F.format_string("media/en/v%d/frames.json", "id")
    return spark.range(0, n, 1, parts).select(key.alias("key"), F.to_json(fields).cast("binary").alias("bytes"))


def test_frames_of_a_store_are_not_listed(spark, tmp_path):
    root = str(tmp_path / "store")
    write_objects(plans_of(spark, 40), "key", "bytes", root)
    frames = read_frames(spark, root, published(spark, root))
    assert not [f for f in frames.inputFiles() if "/_objects/" in f]
    assert {r.video_id: r.num_frames for r in frames.collect()} == {f"v{i}": i for i in range(40)}


def test_frames_objects_lists_no_objects(spark, tmp_path):
    fields = "doc_id long, source string, lang string, text string, n_chars long"
    rows = [(i, "s", "en" if i % 3 else "de", f"text {i}", 30 + i) for i in range(60)]
    spark.createDataFrame(rows, fields).write.parquet(str(tmp_path / "documents.parquet"))
    found = catalog.frames_objects(spark, str(tmp_path))
    assert not [f for f in found.inputFiles() if "/_objects/" in f]
    assert {r.video_id for r in found.collect()} == {str(i) for i in range(60) if i % 3}


def test_frames_are_those_that_are_visible(spark, tmp_path):
    root = tmp_path / "store"
    write_objects(plans_of(spark, 3), "key", "bytes", str(root))
    other = spark.createDataFrame([("media/en/v1/other.json", bytearray(b'{"video_id": "no"}'))], "key string, bytes binary")
    write_objects(other, "key", "bytes", f"file:{root}/")
    left = root / "_objects" / "lost" / "000000-0" / "frames.json"
    left.parent.mkdir(parents=True)
    left.write_text('{"video_id": "lost"}')
    found = read_frames(spark, str(root), published(spark, str(root)))
    assert sorted(r.video_id for r in found.collect()) == ["v0", "v1", "v2"]


def test_listed_frames_are_read_like_files(spark, tmp_path):
    """Arrays, broken and empty files give the same rows by either way of finding them."""
    whole = json.dumps({"video_id": "a", "num_frames": 3, "frames": ["x", "y"]})
    texts = [whole, f"[{whole}, {whole}]", "", " ", "[]", "{}", "null", "5", whole[:20], f"{whole}\n{whole}", whole.replace("3", '"x"')]
    contents = [t.encode() for t in texts] + [b"\xef\xbb\xbf" + whole.encode(), whole.encode("utf-16"), b'{"video_id": "\xff"}']
    rows = [(f"{i}/frames.json", bytearray(c)) for i, c in enumerate(contents)]
    root = str(tmp_path / "store")
    write_objects(spark.createDataFrame(rows, "key string, bytes binary"), "key", "bytes", root)
    by_files, by_index = read_frames(spark, root + "/_objects"), read_frames(spark, root, published(spark, root))
    assert by_files.schema == by_index.schema
    assert sorted(map(str, by_index.collect())) == sorted(map(str, by_files.collect()))
