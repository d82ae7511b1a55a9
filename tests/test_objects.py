"""Objects become visible all at once, or not at all."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from framelark.sinks.objects import published, read_objects, write_objects

ROOT = Path(__file__).resolve().parent.parent


def rows_of(spark, n, word="a", parts=3):
    df = spark.range(0, n, 1, parts)
    return df.select(F.format_string("clips/v%03d/video.mp4", "id").alias("key"), F.concat(F.lit(word), "id").cast("binary").alias("bytes"))


def stored(spark, root):
    return {r.key: bytes(r.content).decode() for r in read_objects(spark, root).collect()}


def test_objects_are_written_and_read_back(spark, tmp_path):
    root = str(tmp_path / "store")
    assert published(spark, root).isEmpty()
    write_objects(rows_of(spark, 7), "key", "bytes", root)
    assert stored(spark, root) == {f"clips/v{i:03d}/video.mp4": f"a{i}" for i in range(7)}
    # A second job replaces what it writes and leaves the rest; an empty one changes nothing.
    write_objects(rows_of(spark, 3, "new"), "key", "bytes", root)
    write_objects(rows_of(spark, 0), "key", "bytes", root)
    found = stored(spark, root)
    assert [found[f"clips/v{i:03d}/video.mp4"] for i in range(4)] == ["new0", "new1", "new2", "a3"] and len(found) == 7
    assert {r.length for r in published(spark, root).filter("key like '%v001%'").collect()} == {4}


@pytest.mark.parametrize("key", ["../out", "/abs", ""])
def test_keys_stay_below_the_root(spark, tmp_path, key):
    df = spark.createDataFrame([(key, bytearray(b"x"))], "key string, bytes binary")
    with pytest.raises(Exception, match="not the key"):
        write_objects(df, "key", "bytes", str(tmp_path / "store"))


def test_a_failing_task_leaves_no_visible_object(spark, tmp_path):
    root = str(tmp_path / "store")
    write_objects(rows_of(spark, 2), "key", "bytes", root)
    broken = rows_of(spark, 40, "b", 4).withColumn(
        "bytes", F.when(F.col("key").contains("v039"), F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("bytes"))
    )
    with pytest.raises(Exception, match="lost"):
        write_objects(broken, "key", "bytes", root)
    assert stored(spark, root) == {"clips/v000/video.mp4": "a0", "clips/v001/video.mp4": "a1"}
    assert {r.job for r in published(spark, root).collect()} == {f.stem.split("-")[1] for f in (tmp_path / "store" / "_published").iterdir() if f.suffix == ".json"}
    # A later job is not disturbed by what the aborted one may have left.
    write_objects(rows_of(spark, 1, "c"), "key", "bytes", root)
    assert stored(spark, root) == {"clips/v000/video.mp4": "c0", "clips/v001/video.mp4": "a1"}


FAILS_ONCE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession
from framelark.sinks.objects import published, read_objects, write_objects
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()

def once(frames):
    for frame in frames:
        yield frame.iloc[:2]
        if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
            raise RuntimeError("first attempt")
        yield frame.iloc[2:]

df = spark.range(0, 20, 1, 2).selectExpr("concat('k', id) as key", "cast(concat('v', id) as binary) as bytes")
write_objects(df.mapInPandas(once, df.schema), "key", "bytes", {root!r})
found = read_objects(spark, {root!r}).collect()
print("FOUND", len(found), len({{r.key for r in found}}), all(bytes(r.content) == b"v" + r.key[1:].encode() for r in found))
"""


def test_a_task_that_fails_once_writes_each_object_once(tmp_path):
    code = FAILS_ONCE.format(repo=str(ROOT), root=str(tmp_path / "store"))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env={**__import__("os").environ, "PYTHONPATH": str(ROOT)})
    assert "FOUND 20 20 True" in done.stdout, done.stderr[-2000:]
    # The first attempt of the second task wrote something, which no index lists.
    attempts = list((tmp_path / "store" / "_objects").glob("*/*"))
    assert len(attempts) in (2, 3) and len(list((tmp_path / "store" / "_indexes").glob("*/*.json"))) == 2
