"""Result logs: line scanning, classification, merging, resuming."""

import gzip
import json

import pytest

from framelark.operators.pending import reconcile_counts, resume_pending
from framelark.plans import results
from framelark.schemas import INFERENCE_MANIFEST
from framelark.sinks import write_merge
from framelark.sources import list_files, parse_strict, read_lines
from framelark.sources.jsonl import LINE_ORDER

FILES = {
    "shard-00000.jsonl": [
        '{"id": "a", "output": "old", "model": "m"}',
        "",
        "   \t ",
        '{"id": "b", "error": "image_load: x", "prompt": "p"}',
        '{"id": 7, "output": "number"}',
        '{"id": "c", "output": "first"}\r',
        '{"id": "u", "output": "line separator"}',
        '{"id": "torn", "outp',
    ],
    "shard-00001.jsonl": [
        "5",
        '"error"',
        "[]",
        "null",
        '{"id": "x"}{"id": "y"}',
        "{'id': 'q'}",
        '{"id": "b", "output": "fixed", "extra": {"k": [1]}}',
        '{"id": "c", "error": null}',
        '{"output": "no id"}',
        '{"id": null, "output": "null id"}',
        '{"id": "a", "output": "new", "model": "m"}',
    ],
    "deep/shard-00002.jsonl": ['{"id": "d", "output": "deep"}', '{"id": "a2", "output": NaN}'],
    "shard-00003.jsonl": [],
    "notes.txt": ['{"id": "ignored", "output": "not a shard"}'],
}


@pytest.fixture
def shards(tmp_path):
    for name, lines in FILES.items():
        path = tmp_path / "shards" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + ("\n" if lines and "torn" not in lines[-1] else ""), encoding="utf-8")
    return str(tmp_path / "shards")


def expected_merge():
    """The merge by hand, over the files in path order."""
    ok, failed = {}, []
    for name in sorted(n for n in FILES if n.endswith(".jsonl")):
        for line in FILES[name]:
            try:
                record = json.loads(line)
            except json.JSONDecodeError:
                continue
            if not isinstance(record, dict):
                continue
            if "error" in record:
                failed.append(record)
            elif record.get("id") is not None:
                ok[str(record["id"])] = record
    return ok, failed


def log_of(spark, path):
    return results.classified(read_lines(spark, path))


def test_merge_is_last_wins_in_first_seen_order(spark, shards):
    ok, failed = expected_merge()
    log = log_of(spark, shards)
    train = results.in_output_order(results.merged(log, LINE_ORDER)).collect()
    assert [r.id for r in train] == list(ok)
    assert [r.output for r in results.parsed(log).filter("id = 'a'").orderBy(*LINE_ORDER).collect()] == ["old", "new"]
    for row in train:
        if "NaN" not in row.raw:
            assert json.loads(row.raw) == ok[row.id]
    found = results.errors(log).orderBy(*LINE_ORDER).collect()
    assert [json.loads(r.raw) for r in found] == failed
    assert [r.raw for r in results.rejected(log).orderBy(*LINE_ORDER).collect()] == [
        '{"output": "no id"}',
        '{"id": null, "output": "null id"}',
    ]


def test_line_order_survives_splits(spark, tmp_path):
    for f in range(3):
        lines = [json.dumps({"id": i % 50, "output": f"{f}-{i}"}) for i in range(2000)]
        (tmp_path / f"shard-{f:05d}.jsonl").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        lines = read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 10
        rows = results.parsed(results.classified(lines)).orderBy(*LINE_ORDER).select("output").collect()
        assert [r.output for r in rows] == [f"{f}-{i}" for f in range(3) for i in range(2000)]
        train = results.merged(results.classified(lines), LINE_ORDER).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.id: json.loads(r.raw)["output"] for r in train} == {str(i): f"2-{1950 + i}" for i in range(50)}


def test_counts(spark, shards):
    files = list_files(spark, shards, "*.jsonl")
    assert [f.rsplit("/", 1)[1] for f in files] == ["shard-00002.jsonl", "shard-00000.jsonl", "shard-00001.jsonl", "shard-00003.jsonl"]
    row = results.counts(log_of(spark, shards), n_files=len(files)).first()
    ok, failed = expected_merge()
    assert (row.n_files, row.n_ok, row.n_errors, row.n_rejected) == (4, len(ok), len(failed), 2)


def test_unresolved_errors(spark, shards):
    assert results.errors(log_of(spark, shards), unresolved_only=True).count() == 0
    more = spark.createDataFrame([('{"id": "z", "error": "e"}',), ('{"id": "y", "error": "e"}',), ('{"id": "y"}',)], "raw string")
    rows = results.errors(results.classified(more), unresolved_only=True).collect()
    assert [r.id for r in rows] == ["z"]


def test_merging_a_merge_changes_nothing(spark, shards, tmp_path):
    log = log_of(spark, shards)
    out = str(tmp_path / "out")
    train = results.in_output_order(results.merged(log, LINE_ORDER))
    write_merge(log, LINE_ORDER, out)
    again = results.merged(results.classified(read_lines(spark, f"{out}/train.jsonl", "*.txt")), LINE_ORDER)
    first = [(r.id, r.raw) for r in train.collect()]
    assert [(r.id, r.raw) for r in results.in_output_order(again).collect()] == first
    assert read_lines(spark, f"{out}/errors.jsonl", "*.txt").count() == results.errors(log).count()
    # A later merge without errors leaves no old ones behind.
    write_merge(log.filter("not is_error"), LINE_ORDER, out)
    assert read_lines(spark, f"{out}/errors.jsonl", "*.txt").count() == 0


def test_merge_does_not_depend_on_partitions(spark, shards):
    log = log_of(spark, shards)
    expected = sorted((r.id, r.raw) for r in results.merged(log, LINE_ORDER).collect())
    for n in (1, 3, 9):
        found = results.merged(log.repartition(n), LINE_ORDER).collect()
        assert sorted((r.id, r.raw) for r in found) == expected


def test_strict_scan(spark):
    good = spark.createDataFrame([('{"id": 1, "images": ["a"]}',), ("  ",), ("",), ('{"id": true, "prompt": null}',)], "raw string")
    rows = parse_strict(good, INFERENCE_MANIFEST).orderBy("id").collect()
    assert [(r.id, r.prompt, r.images) for r in rows] == [("1", None, ["a"]), ("true", None, None)]
    for bad in ('{"id": 1', '{"id": 1} x', "null", "5", '{"id": 1},{"id": 2}', '{"id": 1}] [{"id": 2}'):
        with pytest.raises(Exception):
            parse_strict(spark.createDataFrame([(bad,)], "raw string"), INFERENCE_MANIFEST).collect()


def test_resume(spark):
    manifest = spark.createDataFrame(
        [(i, str(i % 8), f"p{i}", None, None) for i in range(12)], f"n int, {INFERENCE_MANIFEST}"
    )
    log = results.classified(
        spark.createDataFrame([('{"id": 1, "output": "o"}',), ('{"id": "2", "error": "e"}',), ('{"output": "x"}',)], "raw string")
    )
    left = {r.id: r.prompt for r in resume_pending(manifest, log, ["n"]).collect()}
    assert left == {"0": "p8", "3": "p11", "4": "p4", "5": "p5", "6": "p6", "7": "p7"}
    retried = resume_pending(manifest, log, ["n"], retry_errors=True)
    assert {r.id for r in retried.collect()} == set(left) | {"2"}
    assert resume_pending(manifest, log).count() == 8


def test_reconcile(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "id string")
    made = spark.createDataFrame([("b",), ("c",), ("x",)], "id string")
    assert tuple(reconcile_counts(wanted, made).first()) == (4, 3, 1, 1, 2, 0, 0)
    unnamed = spark.createDataFrame([(None,), (None,), ("a",)], "id string")
    assert tuple(reconcile_counts(unnamed, unnamed.limit(3)).first()) == (3, 3, 0, 0, 1, 2, 2)


def test_compressed_files_keep_their_order(spark, tmp_path):
    for f in range(2):
        with gzip.open(tmp_path / f"shard-{f:05d}.jsonl.gz", "wt") as out:
            out.writelines(json.dumps({"id": i % 10, "output": f"{f}-{i}"}) + "\n" for i in range(300))
    log = results.classified(read_lines(spark, str(tmp_path), "*.jsonl.gz"))
    train = results.in_output_order(results.merged(log, LINE_ORDER)).collect()
    assert [(r.id, json.loads(r.raw)["output"]) for r in train] == [(str(i), f"1-{290 + i}") for i in range(10)]


def test_an_empty_folder_merges_to_nothing(spark, tmp_path):
    (tmp_path / "shards").mkdir()
    log = log_of(spark, str(tmp_path / "shards"))
    train = results.merged(log, LINE_ORDER)
    assert train.count() == 0 and tuple(results.counts(log).first()) == (0, 0, 0, 0)
    write_merge(log, LINE_ORDER, str(tmp_path / "out"))
    assert (tmp_path / "out" / "train.jsonl" / "_SUCCESS").exists()
