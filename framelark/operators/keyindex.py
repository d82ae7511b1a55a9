"""Results stored in runs, each with a Bloom filter of its keys beside it, so that few runs are read to see what is new.

A filter is cut into containers of 32 768 bits. A key belongs to one container, by its hash, and sets ``HASHES`` bits in it;
so a filter is built by one aggregate, and a key is looked up in one row. A run is read only if its filter may hold one of the
wanted keys, and the join with what it holds is exact: filters prune and decide nothing.

The list of runs, with the sizes of their filters, is a versioned manifest (``sinks.versions``): a run is there when the version
that names it is, whatever a crash left behind.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark.operators.places import CONTAINER, has_bit
from framelark.sinks.versions import latest, publish

#: About one key in a hundred thousand that is not in a run is taken for one that may be.
BITS_PER_KEY = 24
HASHES = 12
_FILTER = "run string, container int, bits binary"


def _container(key: str, containers: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("container"), key), containers).cast("int")


def _bits(key: str) -> list[Column]:
    """The places of a key's bits in its container: an arithmetic progression from two parts of one hash."""
    h = F.xxhash64(F.lit("bits"), key)
    low = F.lit(CONTAINER - 1).cast("bigint")
    first, step = h.bitwiseAND(low), F.shiftrightunsigned(h, 15).bitwiseAND(low).bitwiseOR(F.lit(1).cast("bigint"))
    return [(first + step * i).bitwiseAND(low).cast("int") for i in range(HASHES)]


def key_filter(keys: DataFrame, key: str, containers: int) -> DataFrame:
    """``container, bits`` of a filter of some keys; null is no key."""
    named = keys.filter(F.col(key).isNotNull()).select(
        _container(key, F.lit(containers)).alias("container"), F.explode(F.array(*_bits(key))).alias("bit")
    )
    return named.groupBy("container").agg(F.bitmap_construct_agg("bit").alias("bits"))


def stored_runs(spark: SparkSession, path: str) -> list[dict[str, Any]]:
    """``name, keys, containers`` of every run."""
    return (latest(spark, f"{path}/manifest")[1] or {"runs": []})["runs"]


def _swap(spark: SparkSession, path: str, gone: list[str], new: dict[str, Any], tries: int = 20) -> None:
    """Publish the list of runs without those gone and with a new one; again on top of it if another writer was faster."""
    for left in reversed(range(tries)):
        number, found = latest(spark, f"{path}/manifest")
        runs = [r for r in (found or {"runs": []})["runs"] if r["name"] not in gone]
        try:
            return publish(spark, f"{path}/manifest", number + 1, {"runs": [*runs, new]})
        except Exception:
            if not left or latest(spark, f"{path}/manifest")[0] == number:
                raise


def _written(rows: DataFrame, path: str, key: str) -> dict[str, Any]:
    name = uuid.uuid4().hex
    rows.write.parquet(f"{path}/runs/run={name}")
    stored = rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/runs/run={name}")
    n = stored.filter(F.col(key).isNotNull()).count()
    containers = max(1, -(-n * BITS_PER_KEY // CONTAINER))
    key_filter(stored.select(key), key, containers).write.parquet(f"{path}/filters/run={name}")
    return {"name": name, "keys": n, "containers": containers}


def store_run(rows: DataFrame, path: str, key: str) -> str:
    """Store results as a run, with the filter of their keys; its name."""
    run = _written(rows, path, key)
    _swap(rows.sparkSession, path, [], run)
    return run["name"]


def read_runs(spark: SparkSession, path: str, schema: str, names: list[str] | None = None) -> DataFrame:
    """Rows of the named runs, or of all."""
    listed = [r["name"] for r in stored_runs(spark, path)] if names is None else names
    if not listed:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/runs/run={name}" for name in listed])


def merge_runs(spark: SparkSession, path: str, schema: str, key: str, names: list[str]) -> str:
    """Make some runs one, with one filter for the keys of all; its name. What they were stays until it is cleaned up."""
    run = _written(read_runs(spark, path, schema, names), path, key)
    _swap(spark, path, names, run)
    return run["name"]


def possible(wanted: DataFrame, path: str, key: str) -> DataFrame:
    """``key, run``: the runs that each wanted key may be in. A run that has the key is always among them."""
    spark = wanted.sparkSession
    runs = stored_runs(spark, path)
    if not runs:
        return wanted.select(key).limit(0).withColumn("run", F.lit(None).cast("string"))
    # One entry for each stored run.
    listed = F.array(*[F.struct(F.lit(r["name"]).alias("run"), F.lit(r["containers"]).alias("n")) for r in runs])
    asked = wanted.select(key).filter(F.col(key).isNotNull()).distinct().select(key, F.inline(listed))
    asked = asked.select(key, "run", _container(key, F.col("n")).alias("container"))
    reader = spark.read.option("basePath", f"{path}/filters").schema(_FILTER)
    filters = reader.parquet(*[f"{path}/filters/run={r['name']}" for r in runs])
    found = asked.join(filters, ["run", "container"])
    every = F.lit(True)
    for bit in _bits(key):
        every = every & has_bit(F.col("bits"), bit)
    return found.filter(every).select(key, "run")


def unstored(wanted: DataFrame, path: str, key: str) -> DataFrame:
    """Wanted rows whose key is in no stored run; rows without a key stay. Only runs that may hold one of the keys are read."""
    spark = wanted.sparkSession
    # The names of some of the stored runs, which the driver has listed already.
    hit = [r[0] for r in possible(wanted, path, key).select("run").distinct().collect()]
    kind = wanted.schema[key].dataType.simpleString()
    done = read_runs(spark, path, f"{key} {kind}", sorted(hit))
    return wanted.join(done.select(key).distinct(), key, "left_anti")
