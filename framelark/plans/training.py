"""Training rows, and how two models compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.functions import chat_messages, video_prompt
from framelark.operators.labels import latest_label, with_text_measures


def training_rows(manifest: DataFrame, frames: DataFrame, results: DataFrame, order_by: list[str | Column]) -> DataFrame:
    """Input (messages over the frames) and target (newest answer) per video, where the frames are a table of their own.

    Input and target stay apart, since only the target is learned from. Each side has one row per video, and all are
    keyed by it.
    """
    rows = manifest.select("video_id", "category", "fine_category").join(
        frames.select("video_id", "frames", "num_frames"), "video_id"
    )
    return planned_training_rows(rows, results, order_by)


def planned_training_rows(planned: DataFrame, results: DataFrame, order_by: list[str | Column]) -> DataFrame:
    """``training_rows`` of manifest entries that carry their frames (``frames.with_frame_plan``): one join, with the labels."""
    label = latest_label(results, order_by).select("video_id", "prompt", F.col("answer").alias("target"))
    rows = planned.select("video_id", "category", "fine_category", "frames", "num_frames")
    user = video_prompt(F.size("frames"), "prompt")
    return rows.join(label, "video_id").withColumn("messages", chat_messages(user))


def paired_answers(
    teacher: DataFrame, student: DataFrame, order_by: list[str | Column], keys: list[str] | None = None
) -> DataFrame:
    """Newest teacher and student answer per key, where both exist. Keys are unique before the join."""
    on = keys or ["video_id", "probe"]
    t = latest_label(teacher, order_by, on).select(*on, F.col("answer").alias("teacher_answer"))
    s = latest_label(student, order_by, on).select(*on, F.col("answer").alias("student_answer"))
    return t.join(s, on)


def comparison_report(pairs: DataFrame, script: str, by: str = "probe") -> DataFrame:
    """Per probe: equal answers, and repetition and wanted-script shares of both models over all their text."""
    measured = with_text_measures(pairs, "teacher_answer", script, prefix="t_")
    measured = with_text_measures(measured, "student_answer", script, prefix="s_")
    n = F.count(F.lit(1))

    def ratio(part: str, whole: str) -> Column:
        total = F.nullif(F.sum(whole), F.lit(0).cast("bigint"))
        return F.coalesce(F.sum(part) / total, F.lit(0.0))

    return measured.groupBy(by).agg(
        n.alias("n_pairs"),
        (F.count_if(F.col("teacher_answer").eqNullSafe(F.col("student_answer"))) / n).alias("agreement"),
        ratio("t_n_repeated", "t_n_ngrams").alias("teacher_repetition"),
        ratio("s_n_repeated", "s_n_ngrams").alias("student_repetition"),
        ratio("t_n_script", "t_n_letters").alias("teacher_script_share"),
        ratio("s_n_script", "s_n_letters").alias("student_script_share"),
        F.sum("t_n_words").alias("teacher_words"),
        F.sum("s_n_words").alias("student_words"),
    )
