"""Compaction of a result log that keeps growing, at a cost that follows what is new.

The log is a set of runs: the micro-batches as they were written, and runs made by merging others. Only runs of like size
are merged, ``fanout`` of them at a time, so a line is rewritten once for each time the run it is in grows by that
factor, and never because a small batch arrived beside a large history. Merging is last-wins by file and line and adds
up numbers of lines, so the order of merges does not matter.

Which runs are live is said by a versioned manifest. A merge writes its run aside and then publishes the next version;
readers take the newest one and the batches it does not know yet, and see either the old runs or the new one. Merged
runs are split in folders by the hash of the id, so a look at a few ids opens only theirs.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark.sinks.versions import children, exists, latest, publish, remove, versions
from framelark.streaming.merge import LOG_SCHEMA, merged_rows, unmerged_rows

FANOUT = 8
BUCKETS = 16
_ROW = LOG_SCHEMA.rsplit(", run string", 1)[0]


def bucket_of(key: str | Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _folder(log_path: str) -> str:
    # Hidden from scans of the log as a whole.
    return f"{log_path.rstrip('/')}/_tiers"


def live_runs(spark: SparkSession, log_path: str) -> tuple[int, dict[str, Any]]:
    """(version, manifest): ``runs`` with their paths and rows, ``batches`` known of each checkpoint."""
    number, found = latest(spark, f"{_folder(log_path)}/manifest")
    return number, found or {"runs": [], "batches": {}}


def new_batches(spark: SparkSession, log_path: str, manifest: dict[str, Any]) -> list[tuple[str, int]]:
    """(token, number) of the micro-batches that were written whole since the manifest was made."""
    found = []
    for run in children(spark, log_path):
        if run.startswith("run="):
            token = run.removeprefix("run=")
            known = manifest["batches"].get(token, -1)
            for batch in children(spark, f"{log_path}/{run}"):
                number = int(batch.removeprefix("batch="))
                if number > known and exists(spark, f"{log_path}/{run}/{batch}/_SUCCESS"):
                    found.append((token, number))
    return found


def _read(spark: SparkSession, log_path: str, paths: list[str]) -> DataFrame:
    """Rows of some runs with the bucket of merged ones; batches have none, and their rows are in any."""
    merged = [f"{log_path}/{p}" for p in paths if p.startswith("_tiers/")]
    batches = [f"{log_path}/{p}" for p in paths if not p.startswith("_tiers/")]
    rows = spark.createDataFrame([], f"{_ROW}, bucket int")
    if merged:
        reader = spark.read.option("basePath", f"{_folder(log_path)}/runs").schema(f"{_ROW}, name string, bucket int")
        rows = reader.parquet(*merged).drop("name")
    if batches:
        reader = spark.read.option("basePath", log_path).schema(LOG_SCHEMA)
        found = reader.parquet(*batches).drop("run", "batch").withColumn("bucket", F.lit(None).cast("int"))
        rows = rows.unionByName(found) if merged else found
    return rows


def read_live(spark: SparkSession, log_path: str) -> DataFrame:
    """Rows of all live runs, ``bucket`` being null for those of micro-batches."""
    _, manifest = live_runs(spark, log_path)
    fresh = [f"run={token}/batch={number}" for token, number in new_batches(spark, log_path, manifest)]
    return _read(spark, log_path, [r["path"] for r in manifest["runs"]] + fresh)


def records_of(spark: SparkSession, log_path: str, ids: list[str]) -> DataFrame:
    """Train records of a few ids. Of merged runs, only the folders of their hashes are opened."""
    buckets = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "id string").select(bucket_of("id")).distinct().collect()]
    rows = read_live(spark, log_path).filter(F.col("bucket").isNull() | F.col("bucket").isin(buckets))
    return merged_rows(rows.filter(F.col("id").isin(ids)))


def tier_of(rows: int, fanout: int) -> int:
    """Runs of ``fanout**t`` rows or more, but fewer than ``fanout`` times as many, are of tier t."""
    tier = 0
    while rows >= fanout:
        rows, tier = rows // fanout, tier + 1
    return tier


def _counted(spark: SparkSession, log_path: str, paths: list[str]) -> list[dict[str, Any]]:
    """Batches as runs, with their rows; counted from the files' own statistics."""
    if not paths:
        return []
    rows = spark.read.option("basePath", log_path).schema(LOG_SCHEMA).parquet(*[f"{log_path}/{p}" for p in paths])
    found = {f"run={r['run']}/batch={r['batch']}": r["n"] for r in rows.groupBy("run", "batch").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [{"path": p, "rows": found.get(p, 0)} for p in paths]


def compact_tiers(spark: SparkSession, log_path: str, fanout: int = FANOUT) -> list[dict[str, int]]:
    """Merge runs of like size until fewer than ``fanout`` are of any one tier; what each merge read and wrote.

    One process at a time: another one's version makes this one fail, with nothing lost and its run never live.
    Replaced runs stay for readers that still use them, until ``remove_dead``.
    """
    log_path = log_path.rstrip("/")
    number, manifest = live_runs(spark, log_path)
    fresh = new_batches(spark, log_path, manifest)
    runs = manifest["runs"] + _counted(spark, log_path, [f"run={token}/batch={n}" for token, n in fresh])
    batches = dict(manifest["batches"])
    for token, n in fresh:
        batches[token] = max(n, batches.get(token, -1))
    done = []
    while True:
        tiers = defaultdict(list)
        for run in runs:
            tiers[tier_of(run["rows"], fanout)].append(run)
        full = [t for t, members in sorted(tiers.items()) if len(members) >= fanout]
        if not full:
            break
        chosen = sorted(tiers[full[0]], key=lambda r: r["rows"])[:fanout]
        made = _merge(spark, log_path, [r["path"] for r in chosen])
        done.append({"tier": full[0], "runs": len(chosen), "rows_read": sum(r["rows"] for r in chosen), "rows_written": made["rows"]})
        paths = {r["path"] for r in chosen}
        runs = [r for r in runs if r["path"] not in paths] + [made]
        number += 1
        publish(spark, f"{_folder(log_path)}/manifest", number, {"runs": runs, "batches": batches})
    if fresh and not done:
        publish(spark, f"{_folder(log_path)}/manifest", number + 1, {"runs": runs, "batches": batches})
    return done


def _merge(spark: SparkSession, log_path: str, paths: list[str]) -> dict[str, Any]:
    rows = _read(spark, log_path, paths).drop("bucket")
    kept = merged_rows(rows).select("raw", "last_seen.*", "id", F.lit(False).alias("is_error"), "first_seen", "n_records")
    rest = unmerged_rows(rows).select(*kept.columns)
    path = f"_tiers/runs/name={uuid.uuid4().hex}"
    whole = kept.unionByName(rest).withColumn("bucket", bucket_of(F.coalesce("id", "raw")))
    whole.write.partitionBy("bucket").parquet(f"{log_path}/{path}")
    reader = spark.read.option("basePath", f"{log_path}/_tiers/runs").schema(f"{_ROW}, name string, bucket int")
    return {"path": path, "rows": reader.parquet(f"{log_path}/{path}").count()}


def remove_dead(spark: SparkSession, log_path: str) -> list[str]:
    """Delete runs that no version from the newest on names, and older versions; the paths that went.

    For when no reader uses what it found earlier. Micro-batches the manifest does not know yet stay.
    """
    log_path = log_path.rstrip("/")
    number, manifest = live_runs(spark, log_path)
    live = {r["path"] for r in manifest["runs"]}
    merged = [f"_tiers/runs/{name}" for name in children(spark, f"{_folder(log_path)}/runs") if name.startswith("name=")]
    batches = [
        f"run={token}/{batch}"
        for token, last in manifest["batches"].items()
        for batch in children(spark, f"{log_path}/run={token}")
        if int(batch.removeprefix("batch=")) <= last
    ]
    dead = [p for p in (*merged, *batches) if p not in live]
    for path in dead:
        remove(spark, f"{log_path}/{path}")
    for old in versions(spark, f"{_folder(log_path)}/manifest"):
        if old < number:
            remove(spark, f"{_folder(log_path)}/manifest/{old:012d}.json")
    return dead
