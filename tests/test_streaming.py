"""Streams against the batch results of the same files."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from framelark.plans import results
from framelark.sources import read_lines
from framelark.sources.jsonl import LINE_ORDER
from framelark.streaming import (
    append_log,
    checkpoint_token,
    compact_log,
    merged_log,
    read_progress,
    read_scored,
    score_manifest_stream,
    stream_lines,
)


def drop(path, name, rows):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_files_in_two_steps_merge_as_one_batch(spark, tmp_path):
    source, log, checkpoint = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "cp")

    def run():
        append_log(stream_lines(spark, str(source), files_per_batch=1), log, checkpoint).awaitTermination()
        return sorted((r.id, r.raw, r.n_records) for r in merged_log(spark, log).collect())

    drop(source, "shard-00001.jsonl", [{"id": i, "output": f"late {i}"} for i in range(5)])
    drop(source, "shard-00002.jsonl", [{"id": 9, "error": "e"}, {"id": 9, "output": "ok"}])
    assert len(run()) == 6
    # This one sorts before the others, so its lines lose although they come last.
    drop(source, "shard-00000.jsonl", [{"id": i, "output": f"early {i}"} for i in range(8)])
    found = run()
    batch = results.merged(results.classified(read_lines(spark, str(source))), LINE_ORDER).collect()
    assert found == sorted((r.id, r.raw, r.n_records) for r in batch)
    assert run() == found

    compacted = str(tmp_path / "compact")
    compact_log(spark, compacted, log)
    shown = lambda log: sorted(merged_log(spark, log).select("id", "raw", "first_seen", "last_seen", "n_records").collect())
    assert shown(compacted) == shown(log) and len(shown(log)) == len(found)
    # Compacting again, with the log that came after, adds the numbers up.
    compact_log(spark, str(tmp_path / "twice"), compacted)
    assert shown(str(tmp_path / "twice")) == shown(log)
    with pytest.raises(ValueError, match="written over"):
        compact_log(spark, log, compacted, log)
    assert spark.read.parquet(compacted).filter("is_error").count() == 1


def test_scoring_goes_on_where_it_stopped(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def load(reference):
        if reference == "bad":
            raise OSError("gone")
        return reference

    def make(word):
        def factory():
            def generate(batch):
                return [f"{word} {item['prompt']}" for item in batch]

            return generate

        return factory

    def run(word):
        score_manifest_stream(spark, str(source), out, checkpoint, make(word), load, "m").awaitTermination()
        return {r.id: r.output or r.error for r in read_scored(spark, out).collect()}

    drop(source, "part-0.jsonl", [{"id": 1, "prompt": "a"}, {"id": 2, "prompt": "b", "image": "bad"}, {"prompt": "no id"}])
    assert run("first") == {"1": "first a", "2": "image_load: gone"}
    # Known ids, failed or not, are not scored again; of a repeated new id the last record counts.
    drop(source, "part-1.jsonl", [{"id": 1, "prompt": "x"}, {"id": 2, "prompt": "y"}, {"id": 3, "prompt": "c"}, {"id": 3, "prompt": "d"}])
    expected = {"1": "first a", "2": "image_load: gone", "3": "second d"}
    assert run("second") == expected
    assert run("third") == expected and read_scored(spark, out).count() == 3


def test_another_checkpoint_neither_loses_nor_repeats(spark, tmp_path):
    """A new checkpoint begins with batch 0 again: what is stored stays, and is not scored a second time."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    drop(source, "part-0.jsonl", [{"id": i, "prompt": "p"} for i in range(4)])

    def make():
        return lambda batch: ["o"] * len(batch)

    for attempt in ("one", "two"):
        score_manifest_stream(spark, str(source), out, str(tmp_path / attempt), make, str, "m").awaitTermination()
    assert read_scored(spark, out).count() == 4

    drop(tmp_path / "new", "part-0.jsonl", [{"id": 3, "prompt": "p"}, {"id": 7, "prompt": "p"}, {"prompt": "no id"}])
    rejects = str(tmp_path / "rejects")
    score_manifest_stream(
        spark, str(tmp_path / "new"), out, str(tmp_path / "three"), make, str, "m", rejects_path=rejects
    ).awaitTermination()
    assert sorted(r.id for r in read_scored(spark, out).collect()) == ["0", "1", "2", "3", "7"]
    assert spark.read.parquet(rejects).count() == 1


def test_a_new_checkpoint_keeps_the_log(spark, tmp_path):
    log = str(tmp_path / "log")
    for n, ids in enumerate(([1, 2], [3])):
        source = tmp_path / f"in{n}"
        drop(source, "shard-0.jsonl", [{"id": i, "output": "o"} for i in ids])
        append_log(stream_lines(spark, str(source)), log, str(tmp_path / f"cp{n}")).awaitTermination()
    assert sorted(r.id for r in merged_log(spark, log).collect()) == ["1", "2", "3"]


def answers(word="o"):
    return lambda: lambda batch: [f"{word} {item['prompt']}" for item in batch]


def spoil(path, before):
    """Makes the result files that were there before unreadable; how many there were."""
    files = [f for f in path.rglob("part-*.parquet") if "run=none" not in str(f) and f not in before]
    for f in files:
        f.write_bytes(b"not read again")
        crc = f.with_name(f".{f.name}.crc")
        if crc.exists():
            crc.unlink()
    return files


def test_earlier_results_are_not_read_again(spark, tmp_path):
    """Every batch brings old ids and new ones; results of earlier batches could not be read any more."""
    source, out, checkpoint = tmp_path / "in", tmp_path / "out", str(tmp_path / "cp")
    spoiled, updated, total = [], [], []
    for n in range(5):
        ids = [*range(10 * n, 10 * n + 10), *range(0, 10 * n, 7)]
        drop(source, f"part-{n}.jsonl", [{"id": i, "prompt": f"{n}"} for i in ids])
        query = score_manifest_stream(spark, str(source), str(out), checkpoint, answers(), str, "m")
        query.awaitTermination()
        state = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
        updated.append((state[0]["numRowsUpdated"], len(ids)))
        total.append(state[0]["numRowsTotal"])
        assert "RocksDB" in str(state[0]["customMetrics"].keys()) or any("rocksdb" in k for k in state[0]["customMetrics"])
        token = checkpoint_token(spark, checkpoint)
        fresh = spark.read.schema("id string").parquet(*[str(f) for f in out.rglob("part-*.parquet") if f"run={token}" in str(f) and f not in spoiled])
        assert sorted(int(r.id) for r in fresh.collect()) == list(range(10 * n, 10 * n + 10))
        spoiled += spoil(out, spoiled)
    # The state is looked up and written for the ids of the batch only.
    assert all(rows == ids for rows, ids in updated) and total == [10, 20, 30, 40, 50]


def test_a_failed_batch_is_repeated_exactly(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def broken():
        raise RuntimeError("no model")

    def run(make, **options):
        score_manifest_stream(spark, str(source), out, checkpoint, make, str, "m", files_per_batch=1, **options).awaitTermination()
        return sorted((r.id, r.output) for r in read_scored(spark, out).collect())

    drop(source, "part-0.jsonl", [{"id": i, "prompt": "a"} for i in range(3)])
    with pytest.raises(Exception, match="no model"):
        run(broken)
    assert read_scored(spark, out).isEmpty()
    drop(source, "part-1.jsonl", [{"id": 2, "prompt": "late"}, {"id": 3, "prompt": "late"}])
    assert run(answers()) == [("0", "o a"), ("1", "o a"), ("2", "o a"), ("3", "o late")]
    assert run(answers("again")) == [("0", "o a"), ("1", "o a"), ("2", "o a"), ("3", "o late")]


def test_errors_are_tried_again_when_their_ids_come_again(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def load(reference):
        if reference == "bad":
            raise OSError("gone")
        return reference

    def run():
        score_manifest_stream(spark, str(source), out, checkpoint, answers(), load, "m", retry_errors=True).awaitTermination()
        return sorted((r.id, r.output or r.error) for r in read_scored(spark, out).collect())

    drop(source, "part-0.jsonl", [{"id": 1, "prompt": "a", "image": "bad"}, {"id": 2, "prompt": "b"}])
    assert run() == [("1", "image_load: gone"), ("2", "o b")]
    # The newest delivery counts, although its file comes first in order.
    drop(source, "part--1.jsonl", [{"id": 1, "prompt": "c"}, {"id": 2, "prompt": "d"}])
    assert run() == [("1", "image_load: gone"), ("1", "o c"), ("2", "o b")]
    drop(source, "part-2.jsonl", [{"id": 1, "prompt": "e"}])
    assert len(run()) == 3


def test_progress_counts_what_each_batch_stored(spark, tmp_path):
    source, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")

    def load(reference):
        if reference == "bad":
            raise OSError("gone")
        return reference

    for n in range(3):
        drop(source, f"part-{n}.jsonl", [{"id": f"{n}-{i}", "image": "bad" if i < n else "ok"} for i in range(4 + n)])
        time.sleep(0.01)
        os.utime(source / f"part-{n}.jsonl", (n + 1, n + 1))
    score_manifest_stream(
        spark, str(source), out, str(tmp_path / "cp"), answers(), load, "m", files_per_batch=1, progress_path=progress
    ).awaitTermination()
    stored = {(r.run, r.batch): (r.n, r.errors) for r in read_scored(spark, out).groupBy("run", "batch").agg(F.count("id").alias("n"), F.count("error").alias("errors")).collect() if r.run != "none"}
    found = read_progress(spark, progress).collect()
    assert {(r.run, r.batch): (r.processed, r.errors) for r in found} == stored
    assert sorted((r.processed, r.errors) for r in found) == [(4, 0), (5, 1), (6, 2)]
    assert all(r.per_second == pytest.approx(r.processed / r.seconds) for r in found)


def test_a_token_that_was_not_written_whole_does_not_block_a_checkpoint(spark, tmp_path):
    (tmp_path / "cp" / "run_token" / "_temporary" / "0").mkdir(parents=True)
    token = checkpoint_token(spark, str(tmp_path / "cp"))
    assert len(token) == 32 and checkpoint_token(spark, str(tmp_path / "cp")) == token
