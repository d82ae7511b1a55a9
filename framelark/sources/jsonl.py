"""JSON Lines text, in file and line order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelark.functions.json import only_element, parsed_once, with_json_fields

LINE_ORDER = ["file", "block", "line"]


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Number lines that were just read and not shuffled.

    Lines of one split are numbered by one task in reading order, and splits of a file are ordered by their start. So
    file, block and line together order the text, without a shuffle.
    """
    return lines.withColumn("line", F.monotonically_increasing_id())


def line_columns() -> list[Column]:
    """Raw text with its file and the start of its split."""
    return [
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    ]


def text_lines(spark: SparkSession, path: str | list[str], pattern: str = "*.jsonl", recursive: bool = True) -> DataFrame:
    """Every line of every matching file below ``path``, with its file and the start of its split."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return reader.text(path).select(*line_columns())


def read_lines(spark: SparkSession, path: str | list[str], pattern: str = "*.jsonl", recursive: bool = True) -> DataFrame:
    """``text_lines`` with the place of each line in its split."""
    return numbered_lines(text_lines(spark, path, pattern, recursive))


def with_line_index(lines: DataFrame, name: str = "row_index", blank: bool = False) -> DataFrame:
    """Add the 0-based number of each line in the order of files and lines; blank lines are dropped unless ``blank``.

    ``lines`` come from ``text_lines``. The text is read twice and neither sorted, exchanged nor written: a first pass counts
    the lines of each split, the counts are summed up (one row for each split, by default 128 MB of text), and in the second
    pass a line's number is that of the lines in earlier splits plus its place in its own. The two passes have to cut the
    files alike, as they do unless files or the number of cores change in between; a line that is not where the
    first pass counted it fails the job.
    """
    kept = lines if blank else lines.filter(F.regexp_like(F.col("raw"), F.lit(r"(?U)\S")))
    kept = numbered_lines(kept)
    splits = kept.groupBy("file", "block").agg(F.min("line").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    found = kept.join(F.broadcast(splits), ["file", "block"], "left")
    place = F.col("line") - F.col("_first")
    moved = F.raise_error(F.concat(F.lit("lines moved between two reads of "), F.col("file"))).cast("bigint")
    number = F.when((place >= 0) & (place < F.col("_n")), F.col("_before") + place).otherwise(moved)
    return found.select(*lines.columns, number.alias(name))


def with_fields(lines: DataFrame, raw: str = "raw", name: str = "fields") -> DataFrame:
    """Lenient scan: lines that hold one JSON object, with its top-level fields as a map of text.

    Blank and broken lines are dropped.
    """
    return with_json_fields(lines, raw, name).filter(F.col(name).isNotNull())


def parse_strict(lines: DataFrame, schema: str, raw: str = "raw") -> DataFrame:
    """Strict scan: blank lines are dropped, a broken line fails the job."""
    kept = lines.filter(F.regexp_like(F.col(raw), F.lit(r"(?U)\S")))
    fields = T.StructType.fromDDL(schema)
    element = T.StructType([*fields, T.StructField("_end", T.StringType())]).simpleString()
    parsed = kept.withColumn("_parsed", parsed_once(raw, element, mode="FAILFAST"))
    broken = F.raise_error(F.concat(F.lit("not one JSON object: "), F.col(raw)))
    rest = [c for c in lines.columns if c != raw]
    record = F.coalesce(only_element("_parsed"), broken).alias("_record")
    return parsed.select(*rest, record).select(*rest, *[F.col("_record")[f].alias(f) for f in fields.names])
