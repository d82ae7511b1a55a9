"""Checking and comparing labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelark.functions import letter_count, letters, longest_repeat, ngrams, repeated_count, script_count, words
from framelark.functions.json import with_json_fields
from framelark.functions.once import once
from framelark.operators.dedup import last_per_key, top_per_group
from framelark.operators.layout import with_previous
from framelark.schemas import CONFIDENCE_LEVELS, LABEL, MAX_ACTIONS, MAX_OBJECTS, QA_PAIRS


def validated(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """One boolean per rule of the label schema, and ``valid`` for all of them.

    An answer with neither actions nor questions is right when its confidence is low: nothing happened in the video.
    """
    return _checked(answers, answer).drop("_label", "_fields")


def _checked(answers: DataFrame, answer: str) -> DataFrame:
    """``validated`` with the fields as text and the typed label."""
    rec = with_json_fields(answers, answer, "_fields")
    # Field by field, so that one of a wrong type does not cost the others.
    fields = T.StructType.fromDDL(LABEL).fields
    typed = [
        (F.col("_fields")[f.name] if f.dataType == T.StringType() else F.from_json(F.col("_fields")[f.name], f.dataType))
        .alias(f.name)
        for f in fields
    ]
    rec = rec.withColumn("_label", once(F.struct(*typed)))
    label = {f.name: F.col("_label")[f.name] for f in fields}
    n_qa = F.size(label["qa"])
    rules = {
        "ok_json": F.col("_fields").isNotNull(),
        "ok_no_fence": ~F.contains(F.col(answer), F.lit("```")),
        "ok_text": label["scene"].isNotNull() & label["camera"].isNotNull() & label["summary"].isNotNull(),
        "ok_actions": F.size(label["actions"]) <= MAX_ACTIONS,
        "ok_objects": (F.size(label["objects"]) <= MAX_OBJECTS)
        & (F.size(F.array_distinct(label["objects"])) == F.size(label["objects"])),
        "ok_qa": (n_qa == QA_PAIRS)
        | ((n_qa == 0) & (F.size(label["actions"]) == 0) & (label["confidence"] == "low")),
        "ok_qa_fields": F.forall(label["qa"], lambda p: p["q"].isNotNull() & p["a"].isNotNull()),
        "ok_confidence": label["confidence"].isin(*CONFIDENCE_LEVELS),
    }
    checked = rec.withColumns({name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()})
    every = F.lit(True)
    for name in rules:
        every = every & F.col(name)
    return checked.withColumn("valid", every)


def _share(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0).cast("bigint"))


def _with_repeats(answers: DataFrame, text: str, n: int, prefix: str = "") -> DataFrame:
    """Words, n-grams and repeated n-grams of a text."""
    grams = answers.withColumn("_w", words(text)).withColumn("_g", ngrams("_w", n))
    return grams.withColumns(
        {
            f"{prefix}n_words": F.size("_w").cast("bigint"),
            f"{prefix}n_ngrams": F.size("_g").cast("bigint"),
            f"{prefix}n_repeated": repeated_count("_g"),
        }
    ).drop("_w", "_g")


def _with_letters(answers: DataFrame, text: str, script: str, prefix: str = "") -> DataFrame:
    """Letters of a text, and those of the wanted script."""
    found = answers.withColumn("_letters", letters(text))
    return found.withColumns(
        {f"{prefix}n_letters": letter_count("_letters"), f"{prefix}n_script": script_count("_letters", script)}
    ).drop("_letters")


def with_text_measures(answers: DataFrame, text: str, script: str, n: int = 2, prefix: str = "") -> DataFrame:
    """Counts that the rates are made of: n-grams, repeated n-grams, letters, letters of the wanted script."""
    return _with_letters(_with_repeats(answers, text, n, prefix), text, script, prefix)


def repetition(answers: DataFrame, text: str, n: int = 2) -> DataFrame:
    """Repeated n-grams per answer: count, and share of all n-grams (0 for answers with none)."""
    rate = F.coalesce(_share(F.col("n_repeated"), F.col("n_ngrams")), F.lit(0.0))
    return _with_repeats(answers, text, n).withColumn("repetition_rate", rate)


def longest_phrases(answers: DataFrame, text: str) -> DataFrame:
    """The longest phrase that an answer says at least twice: its words, how often it is said, and the phrase itself.

    Of several as long, the earliest. Answers that say no word twice have 0, 0 and null.
    """
    found = answers.withColumn("_w", words(text)).withColumn("_r", once(longest_repeat("_w")))
    n = F.col("_r.n_words")
    phrase = F.when(n > 0, F.array_join(F.slice("_w", (F.col("_r.start") + 1).cast("int"), n.cast("int")), " "))
    return found.select(
        *answers.columns, n.alias("phrase_words"), F.col("_r.n_times").alias("phrase_times"), phrase.alias("phrase")
    )


def language_compliance(answers: DataFrame, text: str, script: str, least: float = 0.5) -> DataFrame:
    """Share of letters in the wanted script, and whether that is at least ``least``."""
    counted = _with_letters(answers, text, script)
    share = F.coalesce(_share(F.col("n_script"), F.col("n_letters")), F.lit(0.0))
    return counted.withColumn("script_share", share).withColumn("compliant", share >= least)


def label_quality(
    answers: DataFrame,
    by: str,
    answer: str = "answer",
    gold: str | None = None,
    fields: tuple[str, ...] = ("scene", "camera", "confidence"),
    told: str | None = None,
    n: int = 2,
) -> DataFrame:
    """Parse and rule success per prompt version, in one pass over the answers.

    With ``gold``, a column with the label each answer should have been (JSON too), also the share of equal values of each of
    ``fields`` over the answers of which both sides parse; nulls equal each other. With ``told``, a text field of the
    label, also the share of repeated n-grams in it over all answers that parse (0 if they have none).
    """
    checked = _checked(answers, answer)
    rows = F.count(F.lit(1))
    measures = [
        rows.alias("n_answers"),
        F.count_if("ok_json").alias("n_parsed"),
        F.count_if("valid").alias("n_valid"),
        (F.count_if("ok_json") / rows).alias("parse_rate"),
        (F.count_if("valid") / rows).alias("valid_rate"),
    ]
    if gold is not None:
        checked = with_json_fields(checked, gold, "_gold")
        both = F.col("_fields").isNotNull() & F.col("_gold").isNotNull()
        compared = F.nullif(F.count_if(both), F.lit(0).cast("bigint"))
        measures.append(F.count_if(both).alias("n_compared"))
        for f in fields:
            same = F.col("_fields")[f].eqNullSafe(F.col("_gold")[f])
            measures.append((F.count_if(both & same) / compared).alias(f"agreement_{f}"))
    if told is not None:
        checked = _with_repeats(checked.withColumn("_told", F.col("_fields")[told]), "_told", n, "_")
        repeated = F.sum("_n_repeated") / F.nullif(F.sum("_n_ngrams"), F.lit(0).cast("bigint"))
        measures.append(F.coalesce(repeated, F.lit(0.0)).alias("repetition_rate"))
    return checked.groupBy(by).agg(*measures)


def field_agreement(
    left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], by: list[str] | None = None
) -> DataFrame:
    """Share of equal values per field over the records both sides have. Nulls equal each other.

    Both sides must have unique ``keys``.
    """
    renamed = right.select(*keys, *[F.col(f).alias(f"_r_{f}") for f in fields])
    pairs = left.join(renamed, keys)
    same = {f: F.count_if(F.col(f).eqNullSafe(F.col(f"_r_{f}"))) for f in fields}
    n = F.count(F.lit(1))
    measures = [n.alias("n_pairs")]
    for f, count in same.items():
        measures += [count.alias(f"n_equal_{f}"), (count / F.nullif(n, F.lit(0).cast("bigint"))).alias(f"agreement_{f}")]
    return pairs.groupBy(*(by or [])).agg(*measures)


def latest_label(results: DataFrame, order_by: list[str | Column], keys: list[str] | None = None) -> DataFrame:
    """The newest result of each video (or of each of ``keys``)."""
    return last_per_key(results, keys or ["video_id"], order_by)


def label_changes(
    results: DataFrame, order_by: list[str], answer: str = "answer", parts: int | None = None
) -> DataFrame:
    """Each result with the previous answer for the same video, and whether the answer changed."""
    found = with_previous(results, ["video_id"], order_by, {"previous_answer": answer}, parts)
    changed = F.col("previous_answer").isNotNull() & ~F.col(answer).eqNullSafe(F.col("previous_answer"))
    return found.withColumn("changed", changed)


def dev_subset(
    videos: DataFrame,
    strata: list[str],
    per_stratum: int | None = None,
    key: str = "video_id",
    total: int | None = None,
) -> DataFrame:
    """A fixed small mixed set: the same few videos of each stratum on every run, chosen by the hash of their id.

    ``per_stratum`` takes so many of each. ``total`` takes so many in all (or all there are), dealt to the strata in proportion
    to their videos by largest remainders: each gets the whole part of its share, and what is left goes one by one to
    those that lost the largest fractions (of equal ones, the first in the order of the strata, nulls last). Within a
    stratum, videos come in an order of their own, so new videos move in among the old and reshuffle none.
    """
    if (per_stratum is None) == (total is None):
        raise ValueError("either per_stratum or total")
    order = [F.sha2(F.col(key).cast("string"), 256), F.col(key)]
    if total is None:
        return top_per_group(videos, strata, order, per_stratum)
    counts = videos.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
    n = counts.agg(F.sum("_n")).scalar()
    wanted = F.least(F.lit(total).cast("bigint"), n)
    share = counts.withColumns(
        {"_whole": F.call_function("div", wanted * F.col("_n"), n), "_rest": (wanted * F.col("_n")) % n}
    )
    left = wanted - share.agg(F.sum("_whole")).scalar()
    named = [F.asc_nulls_last(s) for s in strata]
    # At most ``total`` strata can get one more, and no more than that have a whole share: the lists are short.
    next_ones = share.orderBy(F.desc("_rest"), *named).limit(total)
    next_ones = next_ones.withColumn("_place", F.row_number().over(Window.orderBy(F.desc("_rest"), *named)))
    seats = F.col("_whole") + F.when(F.coalesce(F.col("_place") <= left, F.lit(False)), 1).otherwise(0)
    whole = share.filter(F.col("_whole") > 0).withColumn("_place", F.lit(None).cast("int"))
    dealt = next_ones.unionByName(whole).groupBy(*strata).agg(F.max("_whole").alias("_whole"), F.max("_place").alias("_place"))
    dealt = dealt.select(*[F.col(s).alias(f"_of_{s}") for s in strata], seats.alias("_seats")).filter("_seats > 0")
    ranked = top_per_group(videos, strata, order, total)
    same = F.lit(True)
    for s in strata:
        same = same & F.col(s).eqNullSafe(F.col(f"_of_{s}"))
    found = ranked.join(F.broadcast(dealt), same & (F.col("rank") <= F.col("_seats")))
    return found.select(*videos.columns, "rank")


def token_budget(frames: DataFrame, limits: tuple[int, ...], tokens: str = "image_tokens") -> DataFrame:
    """Whether a video's image tokens fit each context limit, and how many such videos fill one."""
    added = {}
    for limit in limits:
        added[f"fits_{limit}"] = F.col(tokens) < limit
        added[f"per_batch_{limit}"] = F.call_function(
            "div", F.lit(limit).cast("bigint"), F.nullif(F.col(tokens), F.lit(0).cast("bigint"))
        )
    return frames.withColumns(added)


def budget_summary(budget: DataFrame, limits: tuple[int, ...], by: list[str], tokens: str = "image_tokens") -> DataFrame:
    """Records, tokens, and how many records fit each context limit."""
    fits = [F.count_if(f"fits_{limit}").alias(f"n_fits_{limit}") for limit in limits]
    return budget.groupBy(*by).agg(F.count(F.lit(1)).alias("n_records"), F.sum(tokens).alias("total_tokens"), *fits)
