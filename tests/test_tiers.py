"""A growing log that is compacted in tiers, beside the batch merge of all its lines."""

import random

import pytest
from pyspark.sql import functions as F
from test_streaming import drop

from framelark.plans import results
from framelark.sinks import versions
from framelark.sources import read_lines
from framelark.sources.jsonl import LINE_ORDER
from framelark.streaming import append_log, compact_tiers, merged_log, read_live, records_of, remove_dead, stream_lines
from framelark.streaming.tiers import live_runs, tier_of


def shown(df):
    """Records with the files where they were seen first and last; line numbers depend on how files are dealt to tasks."""
    return sorted(df.select("id", "raw", "first_seen.file", F.col("last_seen.file").alias("last"), "n_records").collect())


def batch_merge(spark, source):
    return shown(results.merged(results.classified(read_lines(spark, str(source))), LINE_ORDER))


def grow(spark, tmp_path, log, n, rng, size=40):
    rows = [{"id": rng.randrange(200), "output": f"{n}"} if rng.random() < 0.9 else {"error": "e", "id": 7} for _ in range(size)]
    # File names in no order, so later batches bring lines that lose.
    drop(tmp_path / "in", f"shard-{rng.randrange(10**6):06d}.jsonl", [*rows, {"output": "no id"}])
    append_log(stream_lines(spark, str(tmp_path / "in")), log, str(tmp_path / "cp")).awaitTermination()


def test_tiers():
    assert [tier_of(n, 4) for n in (0, 1, 3, 4, 15, 16, 63, 64)] == [0, 0, 0, 1, 1, 2, 2, 3]


def test_compaction_keeps_the_records_and_rewrites_little(spark, tmp_path):
    log, rng = str(tmp_path / "log"), random.Random(3)
    rewritten, lines = 0, 0
    for n in range(13):
        grow(spark, tmp_path, log, n, rng)
        lines += 41
        done = compact_tiers(spark, log, fanout=3)
        assert all(d["runs"] == 3 for d in done)
        rewritten += sum(d["rows_written"] for d in done)
        if n in (4, 8, 12):
            assert shown(merged_log(spark, log)) == batch_merge(spark, tmp_path / "in")
    # Once for each of the tiers that so many lines have, not once for each batch.
    assert rewritten <= lines * 3 and len(live_runs(spark, log)[1]["runs"]) < 9
    assert read_live(spark, log).filter("is_error").count() == sum('"error"' in r.raw for r in read_lines(spark, str(tmp_path / "in")).collect())
    assert read_live(spark, log).filter("id is null and not is_error").count() == 13

    some = records_of(spark, log, ["5", "17", "none"])
    expected = [r for r in batch_merge(spark, tmp_path / "in") if r.id in ("5", "17")]
    assert shown(some) == expected
    plan = records_of(spark, log, ["5"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(bucket" in plan

    # Runs that were replaced may go; a batch that came after the last compaction stays.
    grow(spark, tmp_path, log, 99, rng)
    assert len(remove_dead(spark, log)) > 5 and remove_dead(spark, log) == []
    assert shown(merged_log(spark, log)) == batch_merge(spark, tmp_path / "in")
    assert compact_tiers(spark, log, fanout=100) == [] and shown(merged_log(spark, log)) == batch_merge(spark, tmp_path / "in")


def test_readers_see_the_old_runs_until_the_swap(spark, tmp_path, monkeypatch):
    log, rng = str(tmp_path / "log"), random.Random(4)
    for n in range(3):
        grow(spark, tmp_path, log, n, rng)
    before = merged_log(spark, log)
    from framelark.streaming import tiers

    def stopped(*_):
        raise RuntimeError("stopped before the swap")

    with monkeypatch.context() as m:
        m.setattr(tiers, "publish", stopped)
        with pytest.raises(RuntimeError, match="before the swap"):
            compact_tiers(spark, log, fanout=2)
    expected = batch_merge(spark, tmp_path / "in")
    assert shown(merged_log(spark, log)) == expected
    assert compact_tiers(spark, log, fanout=2)
    # Plans made earlier still find what they read.
    assert shown(before) == expected == shown(merged_log(spark, log))


def test_two_writers_of_one_version(spark, tmp_path):
    folder = str(tmp_path / "manifest")
    assert versions.latest(spark, folder) == (0, None)
    versions.publish(spark, folder, 1, {"a": "é"})
    with pytest.raises(Exception, match="(?i)exist"):
        versions.publish(spark, folder, 1, {"a": 2})
    versions.publish(spark, folder, 2, [1])
    assert versions.latest(spark, folder) == (2, [1]) and versions.versions(spark, folder) == [1, 2]


def test_a_log_of_several_checkpoints(spark, tmp_path):
    log = str(tmp_path / "log")
    for n in range(4):
        source = tmp_path / f"in{n}"
        drop(source, "shard-0.jsonl", [{"id": i, "output": f"{n}"} for i in range(n + 1)])
        append_log(stream_lines(spark, str(source)), log, str(tmp_path / f"cp{n}")).awaitTermination()
        compact_tiers(spark, log, fanout=2)
    found = {r.id: r.n_records for r in merged_log(spark, log).collect()}
    assert found == {"0": 4, "1": 3, "2": 2, "3": 1}
    assert read_live(spark, log).agg(F.sum(F.coalesce("n_records", F.lit(1)))).first()[0] == 10
