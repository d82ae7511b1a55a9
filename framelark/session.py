"""Where intermediate tables go."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is used, but only if driver and tasks are one machine: on a cluster
    each executor would write to its own disk, and readers would miss rows without any error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), f"framelark-{spark.sparkContext.applicationId}")


def own_dir(spark: SparkSession) -> str:
    """This application's folder below the shared one, which other applications may use too."""
    return f"{shared_dir(spark)}/framelark/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in this application's folder; nothing is created yet."""
    return f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage with a table that outlives executors. The table stays until ``drop_staged``, since whatever was made
    from it is lazy and may still read it.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", 0).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete all tables this application staged. For the end of a job, when nothing lazy is left to read them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
