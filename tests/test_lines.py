"""Line numbers of text that is neither sorted nor written."""

import random

import pytest
from pyspark.sql import functions as F

from framelark.operators import sharding
from framelark.sources import read_lines, text_lines, with_line_index


@pytest.fixture
def conf(spark):
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


def write_files(path, seed):
    """Files of very different lengths, with blank lines, both line ends and no end of the last line; the lines in order."""
    rng, lines = random.Random(seed), []
    path.mkdir()
    for f in range(9):
        own = []
        for i in range(rng.choice([0, 1, 3, 40, 400])):
            own.append(rng.choice(["", "   ", "\t"]) if rng.random() < 0.2 else f"file {f} line {i} " + "x" * rng.randint(0, 90))
        end = rng.choice(["\n", "\r\n"])
        (path / f"part-{f}.jsonl").write_text(end.join(own) + rng.choice(["", end]), newline="")
        lines += own
    return lines


@pytest.mark.parametrize("split", ["37", "500", "100000"])
@pytest.mark.parametrize("seed", [1, 2])
def test_lines_are_numbered_over_files_and_splits(spark, tmp_path, conf, split, seed):
    lines = write_files(tmp_path / "in", seed)
    conf("spark.sql.files.maxPartitionBytes", split)
    conf("spark.sql.files.openCostInBytes", "10")
    text = text_lines(spark, str(tmp_path / "in"))
    full = [line for line in lines if line.strip()]
    found = with_line_index(text).collect()
    assert sorted((r.row_index, r.raw) for r in found) == list(enumerate(full))
    dealt = sharding.dealt(with_line_index(text), 4, base=1)
    assert sorted((r.row_index, r.shard) for r in dealt.collect()) == [(i, (i + 1) % 4) for i in range(len(full))]
    # One shard alone: its filter is not taken for one of the lines.
    assert sorted(r.raw for r in dealt.filter("shard = 2").collect()) == sorted(full[1::4])
    sizes = sharding.sliced(with_line_index(text), 48).groupBy("chunk").count().orderBy("chunk").collect()
    assert [r["count"] for r in sizes] == [48] * (len(full) // 48) + ([len(full) % 48] if len(full) % 48 else [])


def test_blank_lines_can_count(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("one\n\n  \nfour\n")
    found = with_line_index(text_lines(spark, str(tmp_path)), "number", blank=True).collect()
    assert [(r.number, r.raw) for r in sorted(found, key=lambda r: r.number)] == [(0, "one"), (1, ""), (2, "  "), (3, "four")]


def test_no_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("")
    (tmp_path / "b.jsonl").write_text("\n \n")
    assert with_line_index(text_lines(spark, str(tmp_path))).collect() == []


def test_lines_that_moved_between_the_passes_are_an_error(spark, tmp_path):
    """The counts are those of other files: numbers would be wrong, so there are none."""
    (tmp_path / "a.jsonl").write_text("1\n2\n3\n")
    lines = text_lines(spark, str(tmp_path))
    shifted = lines.withColumn("block", F.when(F.rand() >= 0, F.monotonically_increasing_id() % 2).otherwise(0))
    with pytest.raises(Exception, match="lines moved"):
        with_line_index(shifted).collect()


def test_the_text_is_not_exchanged(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("1\n2\n")
    plan = with_line_index(text_lines(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan
    assert read_lines(spark, str(tmp_path)).columns == ["raw", "file", "block", "line"]
