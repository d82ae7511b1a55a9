"""Small JSON documents that replace one another as a whole: whoever reads sees the old or the new one, never a mixture.

Each version is a file of its own, written aside and then renamed; a version that is there already is an error, so of
two writers with the same idea only one wins. Works wherever the file system renames within a folder atomically.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it is not there."""
    fs, folder = file_system(spark, path), _path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(_path(spark, path), True)


def versions(spark: SparkSession, folder: str) -> list[int]:
    return [int(name[:-5]) for name in children(spark, folder) if name.endswith(".json") and name[:-5].isdigit()]


def latest(spark: SparkSession, folder: str) -> tuple[int, Any]:
    """(number, document) of the newest version; (0, None) if there is none."""
    found = versions(spark, folder)
    if not found:
        return 0, None
    path = f"{folder}/{max(found):012d}.json"
    stream = file_system(spark, path).open(_path(spark, path))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return max(found), json.loads(text)


def publish(spark: SparkSession, folder: str, number: int, document: Any) -> None:
    """Make this the newest version. An error if another writer was first with that number."""
    jvm = spark.sparkContext._jvm
    aside, final = _path(spark, f"{folder}/.{uuid.uuid4().hex}"), _path(spark, f"{folder}/{number:012d}.json")
    fs = file_system(spark, folder)
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(json.dumps(document, sort_keys=True), "utf-8"))
    finally:
        stream.close()
    # Unlike FileSystem.rename, this one never replaces what is there.
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(final), options)
    except Exception:
        fs.delete(aside, False)
        raise
