"""Runs queries beside their SQL and compares names, counts and values. Also usable from the shell."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(ours, theirs: duckdb.DuckDBPyRelation) -> str:
    """Empty if the two results are the same, whatever their row order."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} vs {sorted(theirs.columns)}"
    a = _normal(ours.columns, [tuple(r) for r in ours.collect()])
    b = _normal(theirs.columns, theirs.fetchall())
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{x}\n   vs {y}"
    return ""


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def type_difference(ours, relation: duckdb.DuckDBPyRelation) -> str:
    theirs = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    wrong = [
        f"{name}: {kind} vs {theirs.get(name)}" for name, kind in ours.dtypes if KINDS.get(kind) != theirs.get(name)
    ]
    return ", ".join(wrong)


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = database(sf), entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            found = query(spark, sf)
            n = found.count()
            took = time.time() - start
            relation = con.sql(oracles[name])
            kinds = type_difference(found, relation)
            wrong = difference(found, relation)
        except Exception as e:  # report and go on with the next one
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:1500]}", flush=True)
            continue
        print(f"{'FAIL' if wrong else 'ok  '} {name} {n} rows {took:.2f}s {kinds} {wrong}", flush=True)


if __name__ == "__main__":
    main()
