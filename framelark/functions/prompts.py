"""Prompt text and chat messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelark.functions.ids import ColumnOrName, _col, first_nonempty
from framelark.schemas import NO_TARGETS


def _numbers(n: Column) -> Column:
    # sequence(1, 0) counts down, so an empty list has to be made by hand.
    return F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))


def video_prompt(n_frames: ColumnOrName, prompt: ColumnOrName) -> Column:
    """One numbered image tag per frame, one per line, then the prompt on its own line."""
    tags = F.transform(_numbers(_col(n_frames)), lambda i: F.concat(F.lit("Frame"), i.cast("string"), F.lit(": <image>")))
    return F.concat(F.array_join(tags, "\n"), F.lit("\n"), _col(prompt))


def batch_prompt(n_images: ColumnOrName, prompt: ColumnOrName) -> Column:
    """Image tags for free-standing images: numbered when there are several, bare for one, none for none."""
    n = _col(n_images)
    many = F.transform(_numbers(n), lambda i: F.concat(F.lit("Image-"), i.cast("string"), F.lit(": <image>\n")))
    tags = F.when(n > 1, F.array_join(many, "")).when(n == 1, F.lit("<image>\n")).otherwise(F.lit(""))
    return F.concat(tags, _col(prompt))


def chat_messages(user: ColumnOrName, system: ColumnOrName | None = None) -> Column:
    """Message list of role and content; the system message only where there is one."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    turn = message("user", _col(user))
    if system is None:
        return F.array(turn)
    text = _col(system)
    return F.when(F.coalesce(text, F.lit("")) != "", F.array(message("system", text), turn)).otherwise(F.array(turn))


def fill_template(
    template: str,
    n_frames: ColumnOrName,
    interval: ColumnOrName,
    domain_hint: ColumnOrName,
    target_classes: ColumnOrName,
) -> Column:
    """Put the four values in their ``{{NAME}}`` places; no target classes reads as the word for none."""
    values = {
        "{{N_FRAMES}}": _col(n_frames).cast("string"),
        "{{FRAME_INTERVAL}}": _col(interval).cast("string"),
        "{{DOMAIN_HINT}}": F.coalesce(_col(domain_hint), F.lit("")),
        "{{TARGET_CLASSES}}": first_nonempty(target_classes, F.lit(NO_TARGETS)),
    }
    text = F.lit(template)
    for place, value in values.items():
        text = F.replace(text, F.lit(place), value)
    return text
