"""Filters of stored keys: none that is there is missed, and runs that cannot have one are not read."""

from concurrent.futures import ThreadPoolExecutor

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framelark.operators.keyindex import key_filter, merge_runs, possible, read_runs, store_run, stored_runs, unstored

SCHEMA = "id string, output string"


def frame(spark, ids):
    return spark.createDataFrame([(i, f"o{i}") for i in ids], SCHEMA)


@settings(max_examples=12, deadline=None)
@given(runs=st.lists(st.lists(st.one_of(st.none(), st.text(max_size=6)), max_size=30), max_size=4), asked=st.lists(st.text(max_size=3), max_size=30))
def test_no_key_is_missed(spark, tmp_path_factory, runs, asked):
    path = str(tmp_path_factory.mktemp("keys"))
    for ids in runs:
        store_run(frame(spark, ids), path, "id")
    stored = {i for ids in runs for i in ids if i is not None}
    wanted = [*asked, *sorted(stored), None]
    maybe = {(r.id, r.run) for r in possible(frame(spark, wanted), path, "id").collect()}
    for run, ids in zip(stored_runs(spark, path), runs):
        assert {(i, run["name"]) for i in ids if i is not None} <= maybe
    left = [r.id for r in unstored(frame(spark, wanted), path, "id").collect()]
    assert sorted(left, key=repr) == sorted([i for i in wanted if i not in stored], key=repr)


def test_few_keys_are_taken_for_others(spark, tmp_path):
    path = str(tmp_path)
    ids = spark.range(60_000).select(F.col("id").cast("string").alias("id"), F.lit("o").alias("output"))
    store_run(ids, path, "id")
    assert stored_runs(spark, path)[0]["containers"] == 44
    others = spark.range(10**6, 10**6 + 200_000).select(F.col("id").cast("string").alias("id"))
    assert possible(others, path, "id").count() <= 10
    assert possible(ids, path, "id").count() == 60_000


def test_runs_without_a_wanted_key_are_not_read(spark, tmp_path):
    path = str(tmp_path)
    names = [store_run(frame(spark, [f"{r}-{i}" for i in range(500)]), path, "id") for r in range(5)]
    # Unreadable, but for the two runs that have a wanted key.
    for name in (names[0], names[2], names[4]):
        for f in (tmp_path / "runs" / f"run={name}").glob("part-*"):
            f.write_bytes(b"not to be read")
            f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    left = unstored(frame(spark, ["1-7", "3-499", "9-1", "1-500"]), path, "id")
    assert sorted(r.id for r in left.collect()) == ["1-500", "9-1"]
    read = {f.split("run=")[1].split("/")[0] for f in left.inputFiles() if "run=" in f}
    assert read == {names[1], names[3]}


def test_merged_runs_have_one_filter(spark, tmp_path):
    path = str(tmp_path)
    names = [store_run(frame(spark, [f"{r}-{i}" for i in range(2000)]), path, "id") for r in range(3)]
    merged = merge_runs(spark, path, SCHEMA, "id", names[:2])
    assert [(r["name"], r["keys"], r["containers"]) for r in stored_runs(spark, path)] == [(names[2], 2000, 2), (merged, 4000, 3)]
    assert read_runs(spark, path, SCHEMA).count() == 6000
    assert [r.id for r in unstored(frame(spark, ["0-1", "1-1999", "2-5", "2-2000"]), path, "id").collect()] == ["2-2000"]


def test_writers_at_the_same_time_lose_no_run(spark, tmp_path):
    path = str(tmp_path)
    with ThreadPoolExecutor(4) as pool:
        names = list(pool.map(lambda r: store_run(frame(spark, [str(r)]), path, "id"), range(6)))
    assert sorted(r["name"] for r in stored_runs(spark, path)) == sorted(names)


def test_an_empty_store_and_empty_filters(spark, tmp_path):
    wanted = frame(spark, ["a", None, "a"])
    assert unstored(wanted, str(tmp_path), "id").count() == 3
    store_run(frame(spark, []), str(tmp_path), "id")
    assert unstored(wanted, str(tmp_path), "id").count() == 3 and unstored(wanted.limit(0), str(tmp_path), "id").isEmpty()
    assert key_filter(wanted, "id", 1).count() == 1
