"""One object for each row, all of them published at once or none.

A Python data source: tasks write objects under names of their own attempt, with an index of what they wrote, and return
the place of the index as their commit message. When all tasks are done, the driver writes one small document that lists the
indexes of the attempts that count. Only objects in a listed index are visible; what failed, repeated or speculative
attempts left is in no list, and goes when the job is aborted, but for what tasks write after that. The driver handles one message per task, never one per object.

Objects are written with ``pyarrow.fs``, so the root is a path or URI that it can open on every executor.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from framelark.operators.dedup import last_per_key
from framelark.sources.files import opened, read_listed

NAME = "framelark_objects"
_INDEX = "key string, path string, length bigint, job string"


@dataclass
class Written(WriterCommitMessage):
    index: str
    objects: int


class ObjectWriter(DataSourceWriter):
    """Rows of (key, content) to objects below ``root``."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.job = uuid.uuid4().hex

    def write(self, iterator) -> Written:
        files, root = opened(self.root)
        context = TaskContext.get()
        attempt = f"_objects/{self.job}/{context.partitionId():06d}-{context.taskAttemptId()}"
        lines = []
        for row in iterator:
            key, content = row[0], bytes(row[1])
            if not key or key.startswith("/") or ".." in key.split("/"):
                raise ValueError(f"not the key of an object: {key!r}")
            path = f"{attempt}/{key}"
            files.create_dir(f"{root}/{path}".rsplit("/", 1)[0], recursive=True)
            with files.open_output_stream(f"{root}/{path}") as out:
                out.write(content)
            lines.append(json.dumps({"key": key, "path": path, "length": len(content), "job": self.job}))
        index = f"_indexes/{self.job}/{attempt.rsplit('/', 1)[1]}.json"
        if lines:
            files.create_dir(f"{root}/_indexes/{self.job}", recursive=True)
            with files.open_output_stream(f"{root}/{index}") as out:
                out.write(("\n".join(lines) + "\n").encode())
        return Written(index if lines else "", len(lines))

    def commit(self, messages) -> None:
        files, root = opened(self.root)
        done = [m for m in messages if m is not None and m.index]
        document = {"job": self.job, "indexes": [m.index for m in done], "objects": sum(m.objects for m in done)}
        files.create_dir(f"{root}/_published", recursive=True)
        number = 1 + max([int(f.base_name.split("-")[0]) for f in files.get_file_info(arrow_fs.FileSelector(f"{root}/_published")) if f.base_name[:1].isdigit()], default=0)
        aside = f"{root}/_published/.{self.job}"
        with files.open_output_stream(aside) as out:
            out.write(json.dumps(document).encode())
        files.move(aside, f"{root}/_published/{number:012d}-{self.job}.json")

    def abort(self, messages) -> None:
        """Deletes what the job wrote. Tasks that are still ending may write meanwhile; what they leave is in no list."""
        files, root = opened(self.root)
        for _ in range(5):
            try:
                left = [f"{root}/{folder}/{self.job}" for folder in ("_objects", "_indexes")]
                left = [path for path in left if files.get_file_info(path).type == arrow_fs.FileType.Directory]
                for path in left:
                    files.delete_dir(path)
                if not left:
                    return
            except OSError:
                pass
            time.sleep(0.2)


class ObjectSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> ObjectWriter:
        if [f.dataType.simpleString() for f in schema] != ["string", "binary"]:
            raise ValueError(f"objects are rows of (key string, content binary), got {schema.simpleString()}")
        return ObjectWriter(self.options["path"])


def write_objects(df: DataFrame, key: str, content: str, root: str) -> None:
    """Write one object for each row; all become visible together. A key that was there before gets the new content."""
    df.sparkSession.dataSource.register(ObjectSink)
    rows = df.select(F.col(key).alias("key"), F.col(content).cast("binary").alias("content"))
    rows.write.format(NAME).mode("append").save(root)


def published(spark: SparkSession, root: str) -> DataFrame:
    """``key, path, length, job`` of all visible objects, of each key the newest; ``path`` is below the root.

    Of a key written twice by one job, the one with the greater path counts.
    """
    files, bare = opened(root.rstrip("/"))
    folder = files.get_file_info(arrow_fs.FileSelector(f"{bare}/_published", allow_not_found=True))
    jobs, indexes = [], []
    for n, info in enumerate(sorted((f for f in folder if f.base_name[:1].isdigit()), key=lambda f: f.base_name)):
        with files.open_input_stream(info.path) as found:
            document = json.loads(found.read())
        jobs.append((document["job"], n))
        indexes += [f"{root.rstrip('/')}/{i}" for i in document["indexes"]]
    if not indexes:
        return spark.createDataFrame([], _INDEX)
    order = F.broadcast(spark.createDataFrame(jobs, "job string, _n int"))
    rows = spark.read.schema(_INDEX).json(indexes).join(order, "job")
    return last_per_key(rows, ["key"], ["_n", "path"]).select("key", "path", "length", "job")


def read_objects(spark: SparkSession, root: str) -> DataFrame:
    """``key, content, length`` of all visible objects, opened by the names in the indexes; their folders are not listed."""
    return read_listed(published(spark, root), root).select("key", "content", "length")
