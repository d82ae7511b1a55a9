"""Finding and reading the columnar source shards."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelark.schemas import SHARD_ROW

#: Most files, and bytes, of a task that opens files by name.
TASK_FILES, TASK_BYTES = 2000, 64_000_000
#: Contents that such a task holds before it passes them on; a longer file is passed on by itself.
BATCH_BYTES = 4_000_000


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> list[str]:
    """Sorted paths of the files (also the empty ones) below ``path``. No file is opened.

    This is the list the driver holds to plan a scan of them.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    found = reader.option("recursiveFileLookup", str(recursive).lower()).load(path)
    return sorted(unquote(f) for f in found.inputFiles())


def shard_paths(
    spark: SparkSession,
    path: str,
    prefix: str = "train-",
    suffix: str = ".parquet",
    cap: int | None = None,
    recursive: bool = False,
) -> list[str]:
    """Sorted paths of the source shards, at most ``cap`` of them."""
    return list_files(spark, path, f"{prefix}*{suffix}", recursive)[:cap]


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:/*"


def shard_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The list of shard files as a table: ``shard`` (place of the file in the list) and ``path``."""
    return spark.createDataFrame(list(enumerate(paths)), "shard int, path string")


def shard_schema(spark: SparkSession, path: str) -> str:
    """The schema of the fields that are read, with the duration as the kind of number that a shard has it in.

    Only that file's footer is read; all shards of a source have one schema.
    """
    found = spark.read.parquet(path).schema
    fields = found["json"].dataType if "json" in found.names else T.StructType()
    if isinstance(fields, T.StructType) and "duration_seconds" in fields.names:
        kind = fields["duration_seconds"].dataType.simpleString()
        return SHARD_ROW.replace("duration_seconds: bigint", f"duration_seconds: {kind}")
    return SHARD_ROW


def read_shard_table(table: DataFrame, schema: str | None = None) -> DataFrame:
    """Rows of the shards in a table of them, under the numbers they have there.

    What is left of the table is the list of files that the driver plans the scan with; no other file is opened or listed.
    """
    left = table.select("shard", "path").orderBy("shard").collect()
    return read_shards(table.sparkSession, [r["path"] for r in left], schema, [r["shard"] for r in left])


def read_shards(
    spark: SparkSession, paths: list[str], schema: str | None = None, numbers: list[int] | None = None
) -> DataFrame:
    """Rows of the listed shards with ``shard`` (place of the file in the list, or its own of ``numbers``) and ``row_pos``
    (place in the file).

    Both come from file metadata, so a query that does not select ``mp4`` never reads the media bytes. ``paths`` are
    full paths, as ``shard_paths`` gives them. Without ``schema`` it is ``shard_schema`` of the first.
    """
    if not paths:
        fields = T.StructType.fromDDL(schema or SHARD_ROW).add("row_pos", T.LongType()).add("shard", T.IntegerType())
        return spark.createDataFrame([], fields)
    rows = spark.read.schema(schema or shard_schema(spark, paths[0])).parquet(*paths)
    # Spark reports paths URL-encoded, and with differing numbers of slashes after the scheme.
    reported = {re.sub(_SCHEME, "", unquote(f)).lstrip("/"): re.sub(_SCHEME, "", f) for f in rows.inputFiles()}
    given = range(len(paths)) if numbers is None else numbers
    places = [(reported[re.sub(_SCHEME, "", p).lstrip("/")], i) for i, p in zip(given, paths)]
    placed = rows.select(
        "*",
        F.regexp_replace(F.col("_metadata.file_path"), _SCHEME, "").alias("_file"),
        F.col("_metadata.row_index").alias("row_pos"),
    )
    # One short row per listed file, so never larger than the driver's own file list; without the hint the media
    # bytes would be shuffled to number them.
    named = F.broadcast(spark.createDataFrame(places, "_file string, shard int"))
    return placed.join(named, "_file").drop("_file")


def opened(root: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of ``root``, and its path there."""
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(root) if "://" in root else (arrow_fs.LocalFileSystem(), root)


def read_listed(listed: DataFrame, root: str) -> DataFrame:
    """``listed`` with ``content``, the bytes of the file at ``path`` below ``root``. Files that are gone are left out.

    ``listed`` has ``path`` and ``length`` of each file. Tasks open files by name: no folder is listed, and the driver, which
    would get all names and plan a scan of them, sees none.
    """
    n, size = listed.agg(F.count(F.lit(1)), F.sum("length")).first()
    tasks = max(1, -(-n // TASK_FILES), -(-(size or 0) // TASK_BYTES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, bare = opened(root.rstrip("/"))
        for batch in batches:
            rows, contents = [], []

            def held(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                part = batch.take(pa.array(rows, pa.int64()))
                columns = [*part.columns, pa.array(contents, pa.binary())]
                return pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "content"])

            size = 0
            for i, path in enumerate(batch.column("path").to_pylist()):
                try:
                    with files.open_input_stream(f"{bare}/{path}") as found:
                        content = found.read()
                except FileNotFoundError:
                    continue
                if rows and size + len(content) > BATCH_BYTES:
                    yield held()
                    rows, contents, size = [], [], 0
                rows.append(i)
                contents.append(content)
                size += len(content)
            if rows:
                yield held()

    schema = T.StructType([*listed.schema.fields, T.StructField("content", T.BinaryType())])
    return listed.repartition(tasks, "path").mapInArrow(read, schema)
