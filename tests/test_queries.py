"""Every registered query beside its SQL on the given tables, and what its plan must not contain."""

import subprocess
import sys
from pathlib import Path

import pytest
from compare import database, difference, type_difference
from test_places import paths_above

import __spark_entry__ as entry
from framelark.queries.catalog import QUERIES
from framelark.queries.oracles import ORACLES

ROOT = Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="tables are not there")


@pytest.fixture(scope="module")
def tables():
    return database(SF)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_without_the_optional_folder():
    """The entry file works without the training-data operators, and hides no other missing module."""
    code = "import sys; sys.modules.update({{m: None for m in {0}}}); import __spark_entry__ as e; print(len(e.queries()))"
    run = lambda *names: subprocess.run([sys.executable, "-c", code.format(names)], cwd=ROOT, capture_output=True, text=True)
    assert int(run("corpus_pipeline", "framelark.llm").stdout) == len(QUERIES) == int(run("framelark.llm").stdout)
    assert "ModuleNotFoundError" in run("framelark.operators").stderr


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    found = QUERIES[name](spark, SF)
    relation = tables.sql(ORACLES[name])
    assert type_difference(found, relation) == ""
    assert difference(found, relation) == ""
    plan = plan_of(found)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # The scores of video_infer are stored before its answers are read.
    assert ("MapInPandas" in plan) == (name in ("batch_infer", "probe_infer"))


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["category_filter"](spark, SF))
    assert "EqualTo(lang,en)" in plan and "text" not in plan.split("ReadSchema")[1]
    plan = plan_of(QUERIES["category_histogram"](spark, SF))
    assert "ReadSchema: struct<lang:string>" in plan and "partial_count" in plan


@pytest.mark.parametrize("name", ["latest_label", "resume_pending", "dev_subset", "safe_id_first_wins"])
def test_losers_are_dropped_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_merge_combines_before_its_only_shuffle(spark):
    plan = plan_of(QUERIES["merge_train"](spark, SF))
    assert "partial_max_by" in plan and plan.count("Exchange") == 1 and plan.count("from_json") == 1


@pytest.mark.parametrize("name", ["shard_interleave", "batch_chunks", "table_interleave"])
def test_no_window_over_all_rows(spark, name):
    """The only unpartitioned window is over one row per sorted file, or per split of the text."""
    found = QUERIES[name](spark, SF)
    plan = plan_of(found)
    if name != "table_interleave":
        assert "rangepartitioning" not in plan and "parquet" not in plan.lower()
        assert [kind for kind in paths_above(found, "value")[0] if "Exchange" in kind or "Sort" in kind] == []
    before = plan.split("Exchange SinglePartition")
    assert len(before) == 2 and "HashAggregate" in before[1].split("\n")[1]


def test_done_shard_files_are_not_opened(spark):
    found = QUERIES["ingest_new_only"](spark, "/root/testdata/sf0.01")
    shards = {int(f.split("part=")[1].split("/")[0]) for f in found.inputFiles() if "part=" in f}
    assert shards == {5, 6, 7, 8, 9}


def test_lines_are_counted_once_for_all_counts(spark):
    assert "Expand" not in plan_of(QUERIES["merge_counts"](spark, SF))


def test_videos_are_scored_without_a_self_join(spark):
    assert "Join" not in plan_of(QUERIES["video_infer"](spark, SF))


def test_training_rows_scan_each_table_once(spark):
    """One scan of the manifest, one of the labels, one join; each side is shuffled by video once."""
    plan = plan_of(QUERIES["sft_rows"](spark, SF))
    assert plan.count("FileScan") == 2 and plan.count("Join") == 1
    assert plan.count("Exchange hashpartitioning") == 3
