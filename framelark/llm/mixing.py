"""Mixing sources to target weights by pivotal dependent rounding.

Every document has a wanted number of copies, its source's target over its source's size. Its whole part is certain;
the fraction is rounded together with the others of its source. Two open fractions meet, and a random one of the two
gives as many words to the other as it can until one of them is 0 or 1; each keeps its expected value and the words of
the pair stay what they were. The one still open meets the next. So a group of documents leaves one open fraction, and
those meet again in groups, up a tree, until each source has one left, which is drawn by itself. A source's words thus
come within one document of its target.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

import numpy as np

from framelark.llm.common import columns_of, uniform, unused
from framelark.session import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Documents that meet in one task.
GROUP = 4096
OPEN = "doc_id long, row_hash long, source string, size long, source_size long, target double, base int, frac double, bucket long"


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``).

    Sources in order of code points, null last, weigh ``weights`` in turn. They divide ``share`` times all words by
    weight, none above ``most`` times its own; what is above goes to the others by weight. Sources that reach their
    bound are those first in order of bound over weight, so running sums find them.
    """
    if share > most:
        raise ValueError("the sources cannot hold that many words")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    weighed = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, map(float, weights))), turn.cast("int")))
    weighed = weighed.withColumn("_cap", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * float(share)).alias("_all"),
        F.coalesce(F.sum("_cap").over(before), F.lit(0.0)).alias("_taken"),
        F.sum("_w").over(onward).alias("_rest"),
    )
    summed = summed.withColumn("_full", F.col("_cap") * F.col("_rest") <= F.col("_w") * (F.col("_all") - F.col("_taken")))
    rate = (
        F.max("_all").over(everything) - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)).over(everything)
    ) / F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("_w"))).over(everything)
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(F.least(F.col("_cap"), rate * F.col("_w")))
    return summed.select("source", "source_size", target.alias("target"))


def round_group(size: np.ndarray, frac: np.ndarray, draws: np.ndarray, last: bool) -> np.ndarray:
    """Fractions after rounding: 0 or 1 for all but at most one; for all of them if this is the last group."""
    frac = frac.copy()
    i = -1
    for j in range(len(frac)):
        if i < 0:
            i = j
            continue
        a, b, f, g = size[i], size[j], frac[i], frac[j]
        up, down = min((1 - f) * a, g * b), min(f * a, (1 - g) * b)
        if draws[j] * (up + down) < down:
            full = (1 - f) * a <= g * b
            frac[i], frac[j] = (1.0, g - up / b) if full else (f + up / a, 0.0)
        else:
            full = f * a <= (1 - g) * b
            frac[i], frac[j] = (0.0, g + down / b) if full else (f - down / a, 1.0)
        if full:
            i = j
        if not 1e-12 < frac[i] < 1 - 1e-12:
            frac[i] = round(frac[i])
            i = -1
    if last and i >= 0:
        frac[i] = float(uniform(np.array([i + 1], np.uint64) + np.uint64(int(draws[i] * 2**52)), 9)[0] < frac[i])
    return frac


def copies(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``doc_id, row_hash, source, size, source_size, target, copies``: one row per document of ``docs``.

    ``row_hash`` covers all columns; rows equal in it and in ``doc_id`` are interchangeable. A null text has no words.
    Documents without words cannot move a source's sum and are drawn by themselves; a source without words has the
    target 0. Null is a source. The draws depend on the rows and on ``seed`` alone, so reruns agree. A source with most
    of the rows is spread over groups of about ``GROUP`` documents. No rows give no rows.
    """
    rows = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(*(c.cast("string") for c in columns_of(docs))).alias("row_hash"),
            F.col(source).cast("string").alias("source"),
            words(text).alias("size"),
        ),
        "sizes",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    found = source_targets(sizes.drop("_docs"), list(weights), share, most)
    groups = sizes.select(F.col("source").alias("_s"), F.ceil(F.col("_docs") / GROUP).alias("_groups"))
    per_source = found.join(groups, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    per_source = per_source.withColumnRenamed("source", "_source")
    top = sizes.agg(F.max("_docs")).first()[0] or 0

    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = rows.join(per_source, F.col("source").eqNullSafe(F.col("_source"))).select(
        *rows.columns,
        "source_size",
        "target",
        F.floor(wanted).cast("int").alias("base"),
        (wanted - F.floor(wanted)).alias("frac"),
        F.pmod(F.xxhash64("doc_id", "row_hash", F.lit(seed)), F.col("_groups")).cast("long").alias("bucket"),
    )
    alone = (F.col("size") == 0) | ~F.col("frac").between(1e-12, 1 - 1e-12)
    drawn = F.pmod(F.xxhash64("row_hash", F.lit(seed + 1)), F.lit(2**30)) / float(2**30) < F.col("frac")
    settled = joined.filter(alone).withColumn("frac", drawn.cast("double"))

    def step(last: bool, level: int):
        def rounded(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["size", "doc_id", "row_hash"], ascending=[False, True, True], kind="stable")
            keys = pdf["row_hash"].to_numpy("int64").view(np.uint64)
            keys = keys + np.arange(len(pdf), dtype=np.uint64)
            draws = uniform(keys, seed * 16 + level)
            frac = pdf["frac"].to_numpy("float64")
            return pdf.assign(frac=round_group(pdf["size"].to_numpy("float64"), frac, draws, last))

        return rounded

    is_open = F.col("frac").between(1e-12, 1 - 1e-12)
    parts, still, count, level = [settled], joined.filter(~alone), -(-top // GROUP), 0
    while True:
        last = count <= 1
        done = still.groupBy("source", "bucket").applyInPandas(step(last, level), OPEN)
        if last:
            parts.append(done)
            break
        done = staged(done, "rounded")
        parts.append(done.filter(~is_open))
        still = done.filter(is_open).withColumn("bucket", F.expr(f"bucket div {GROUP}"))
        count, level = -(-count // GROUP), level + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        "doc_id", "row_hash", "source", "size", "source_size", "target",
        (F.col("base") + F.round("frac").cast("int")).alias("copies"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the columns of ``docs`` alone, whatever their names.

    The counts meet the rows by ``doc_id`` and ``row_hash``. Rows that are equal in both have the sum of their copies.
    """
    key, hashed, id_, hash_, n, rows, copy = unused(docs, "_key", "_row_hash", "_id", "_hash", "_copies", "_rows", "_copy")
    taken = copies(docs, **options).groupBy("doc_id", "row_hash").agg(
        F.sum("copies").cast("int").alias(n), F.count(F.lit(1)).alias(rows)
    )
    taken = taken.filter(F.col(n) > 0).withColumnsRenamed({"doc_id": id_, "row_hash": hash_})
    own = docs.select(
        "*", F.col("doc_id").cast("long").alias(key), F.xxhash64(*(c.cast("string") for c in columns_of(docs))).alias(hashed)
    )
    met = own.join(taken, F.col(key).eqNullSafe(F.col(id_)) & (F.col(hashed) == F.col(hash_)))
    once = met.filter(F.col(rows) == 1).unionByName(met.filter(F.col(rows) > 1).dropDuplicates([id_, hash_]))
    return once.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*columns_of(docs))
