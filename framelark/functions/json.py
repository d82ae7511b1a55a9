"""Top-level fields of JSON text, parsed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.functions.once import once

# JSON as Python's parser takes it: NaN is allowed, single quotes are not.
_DIALECT = {"allowSingleQuotes": "false"}


def parsed_once(raw: str, element: str, **options: str) -> Column:
    """Parse text as an array of it and an end mark.

    By itself the parser stops at the end of the first object. Here, text with anything after the object is broken,
    or makes an array in which the end mark is not the second element.
    """
    marked = F.concat(F.lit("["), F.col(raw), F.lit(',{"_end":1}]'))
    return once(F.from_json(marked, f"array<{element}>", {**_DIALECT, **options}))


def only_element(column: str) -> Column:
    """The object before the end mark; null where the text was not exactly one object."""
    ended = (F.size(column) == 2) & (F.get(column, 1)["_end"] == "1")
    return F.when(ended, F.get(column, 0))


def with_json_fields(df: DataFrame, raw: str, name: str = "fields") -> DataFrame:
    """Add the fields of a JSON object as a map of text; null where the text is not exactly one object.

    A key whose value is null is in the map; nested values are JSON text. Of a key that occurs twice the last one counts.
    """
    parsed = df.withColumn("_parsed", parsed_once(raw, "map<string, string>"))
    found = only_element("_parsed")
    # Only an object that repeats a key is made anew: lookups in a map find the first entry.
    repeats = F.size(F.array_distinct(F.map_keys(found))) < F.size(found)
    last = F.filter(
        F.map_entries(found),
        lambda e, i: ~F.array_contains(F.slice(F.map_keys(found), i + 2, F.size(found)), e["key"]),
    )
    return parsed.withColumn(name, once(F.when(repeats, F.map_from_entries(last)).otherwise(found))).drop("_parsed")
