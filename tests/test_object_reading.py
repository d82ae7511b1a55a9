"""Published objects are opened by the names in their indexes; nothing lists their folders for the driver."""

import pytest
from pyspark.sql import functions as F

from framelark.sinks.objects import read_objects, write_objects
from framelark.sources import files


def test_only_indexes_are_files_of_the_scan(spark, tmp_path):
    root = str(tmp_path / "store")
    keys = F.format_string("media/en/v%d/video.mp4", "id")
    rows = spark.range(0, 40, 1, 3).select(keys.alias("key"), F.col("id").cast("string").cast("binary").alias("bytes"))
    write_objects(rows, "key", "bytes", root)
    found = read_objects(spark, root)
    assert len(found.inputFiles()) == 3 and found.count() == 40


@pytest.mark.parametrize("root_of", [str, lambda p: f"file://{p}"])
def test_objects_of_any_name_and_size(spark, tmp_path, monkeypatch, root_of):
    root = root_of(tmp_path / "store")
    wanted = {"_a/.b": b"", "c d/%20é.bin": b"x" * 10, "large": b"y" * (2 * files.BATCH_BYTES), "e/f": b"z" * files.BATCH_BYTES}
    monkeypatch.setattr(files, "TASK_FILES", 3)
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in wanted.items()], "key string, bytes binary").coalesce(1)
    write_objects(df, "key", "bytes", root)
    found = read_objects(spark, root)
    assert found.rdd.getNumPartitions() == 2
    assert {r.key: bytes(r.content) for r in found.collect()} == wanted
    assert {r.key: r.length for r in found.collect()} == {k: len(v) for k, v in wanted.items()}
