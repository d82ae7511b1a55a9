"""Measures on answer text. Every one reads the whole text and is linear in its length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelark.functions.ids import ColumnOrName, _col

# Java's Unicode white space plus the four ASCII separators that Python's str.strip also removes.
_SPACE = r"[\s\x{1c}-\x{1f}]"


def strip(text: ColumnOrName) -> Column:
    """Drop white space of any script at both ends."""
    # The look-behind lets the trailing branch start only at the first space of a run: linear, not quadratic.
    return F.regexp_replace(_col(text), f"(?U)^{_SPACE}+|(?<!{_SPACE}){_SPACE}+$", "")


def words(text: ColumnOrName) -> Column:
    """Words split at white space of any script; no empty ones."""
    return F.filter(F.split(_col(text), f"(?U){_SPACE}+"), lambda w: w != "")


def ngrams(word_list: ColumnOrName, n: int = 2) -> Column:
    """Runs of ``n`` adjacent words. Built from shifted slices, so each word is visited ``n`` times, not once per word."""
    w = _col(word_list)
    count = F.greatest(F.size(w) - (n - 1), F.lit(0))
    grams = F.slice(w, F.lit(1), count)
    for k in range(1, n):
        grams = F.zip_with(grams, F.slice(w, F.lit(k + 1), count), lambda a, b: F.concat(a, F.lit(" "), b))
    return grams


def repeated_count(items: ColumnOrName) -> Column:
    """How many items are repeats of an earlier one."""
    a = _col(items)
    return (F.size(a) - F.size(F.array_distinct(a))).cast("bigint")


def letters(text: ColumnOrName) -> Column:
    """The letters of a text, of any script, with all else removed.

    What lies between letters is removed run by run; far fewer matches than there are letters to count.
    """
    return F.regexp_replace(_col(text), r"[^\p{L}]+", "")


def letter_count(letters_only: ColumnOrName) -> Column:
    return F.length(_col(letters_only)).cast("bigint")


def script_count(letters_only: ColumnOrName, script: str = r"\p{IsHangul}") -> Column:
    """How many letters belong to a script, given as the inside of a regular-expression class."""
    return F.length(F.regexp_replace(_col(letters_only), f"[^{script}]+", "")).cast("bigint")


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeats(items: Column) -> Column:
    return F.size(F.array_distinct(items)) < F.size(items)


def _joined(a: Column, a_from: Column, b: Column, b_from: Column, n: Column) -> Column:
    """Ids of runs made of the run at each of ``n`` places of ``a`` and the run at the same place of ``b``."""
    return F.zip_with(F.slice(a, a_from, n), F.slice(b, b_from, n), lambda x, y: F.xxhash64(x, y))


def longest_repeat(word_list: ColumnOrName) -> Column:
    """The longest run of words that occurs at least twice: struct of ``n_words`` (0 if no word does), ``n_times`` (how
    often the earliest such run occurs; occurrences may overlap) and ``start`` (word from 0 where it begins).

    Ranks are doubled: every place gets an id for the run of 1, 2, 4, ... words from there, made of two ids of half the
    length, until no run of that length repeats. The exact length is then put together from the longest power downwards. That is
    a number of passes that grows with the logarithm of the length, each linear. Ids are 64-bit hashes.
    """
    w = _col(word_list)
    first = F.transform(w, lambda x: F.xxhash64(x))
    one = F.lit(1)

    def doubled(state: Column, _: Column) -> Column:
        last = F.element_at(state["levels"], -1)
        reach = F.pow(F.lit(2), F.size(state["levels"]) - 1).cast("int")
        n = F.size(last) - reach
        longer = F.when(n > 1, _joined(last, one, last, reach + 1, n)).otherwise(F.slice(last, 1, 0))
        grown = _bound(
            longer,
            lambda ids: F.when(
                _repeats(ids), F.struct(F.concat(state["levels"], F.array(ids)).alias("levels"), F.lit(False).alias("done"))
            ).otherwise(F.struct(state["levels"].alias("levels"), F.lit(True).alias("done"))),
        )
        return F.when(state["done"], state).otherwise(grown)

    def levels_of(ids: Column) -> Column:
        start = F.struct(F.array(ids).alias("levels"), (~_repeats(ids)).alias("done"))
        rounds = F.ceil(F.log2(F.greatest(F.size(ids), F.lit(2)))).cast("int")
        return F.aggregate(F.sequence(one, rounds), start, doubled, lambda s: F.when(_repeats(ids), s["levels"]))

    def refined(levels: Column) -> Column:
        def longer(state: Column, i: Column) -> Column:
            more = F.pow(F.lit(2), i - 1).cast("int")
            n = F.size(state["ids"]) - more
            longer_ids = F.when(n > 1, _joined(state["ids"], one, F.element_at(levels, i), state["n"] + 1, n)).otherwise(
                F.slice(state["ids"], 1, 0)
            )
            return _bound(
                longer_ids,
                lambda ids: F.when(
                    _repeats(ids), F.struct(ids.alias("ids"), (state["n"] + more).alias("n"))
                ).otherwise(state),
            )

        whole = F.size(levels)
        start = F.struct(F.element_at(levels, -1).alias("ids"), F.pow(F.lit(2), whole - 1).cast("int").alias("n"))
        lower = F.when(whole > 1, F.sequence(whole - 1, one, F.lit(-1))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(lower, start, longer)

    def found(state: Column) -> Column:
        ids = state["ids"]
        placed = F.array_sort(F.transform(ids, lambda x, i: F.struct(x.alias("id"), i.alias("at"))))

        def earliest(rows: Column) -> Column:
            n = F.size(rows) - 1
            again = F.zip_with(
                F.slice(rows, one, n), F.slice(rows, F.lit(2), n), lambda a, b: F.when(a["id"] == b["id"], a["at"])
            )
            return F.array_min(again)

        start = _bound(placed, earliest)
        return _bound(
            start,
            lambda at: F.struct(
                state["n"].cast("bigint").alias("n_words"),
                _bound(F.get(ids, at), lambda id: F.size(F.filter(ids, lambda x: x == id))).cast("bigint").alias("n_times"),
                at.cast("bigint").alias("start"),
            ),
        )

    levels = _bound(first, levels_of)
    result = _bound(levels, lambda some: F.when(some.isNotNull(), _bound(refined(some), found)))
    none = F.struct(F.lit(0).cast("bigint").alias("n_words"), F.lit(0).cast("bigint").alias("n_times"), F.lit(None).cast("bigint").alias("start"))
    return F.coalesce(F.when(F.size(w) > 1, result), none)
