"""Near copies by ProbMinHash.

A text is a bag of shingles of five words, lower-cased, weighted by how often they occur. The arrivals of a Poisson
process of that rate are drawn for each shingle from its hash and thrown into ``REGISTERS`` registers, each of which
keeps its first arrival; a shingle stops as soon as its next arrival is later than all of them. Two bags have the same
shingle in a register with a probability equal to their probability Jaccard similarity. Texts that agree in a band of
``ROWS`` registers are candidates. A text with repeated shingles has a second signature and bands, with weight 1 for each
shingle, whose agreement estimates the plain Jaccard similarity of the sets.

Copies with the same words are one text from the start. Candidates are first joined to raw components, unverified, so
that each text's shingles meet those of its possible partners once; a component that is too large for a task is cut in
blocks, and every two blocks meet. Inside, pairs are compared exactly from the likeliest down, where either signature makes them likely;
those already in one class need not be. A pair is a link if its probability Jaccard or the plain Jaccard of its shingle sets reaches the
threshold. Classes are the components of the links.

The chance that a pair at the threshold of 0.8 shares no band is 7e-5, and falls quickly above it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.llm.common import chunks_of, columns_of, mix64, uniform, unused
from framelark.llm.components import components
from framelark.session import staged

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
BATCH_BYTES = 4_000_000
#: Texts that meet in one task; two blocks of half as many where a component is larger.
MEET = 2048
#: Compared exactly if either share of equal registers is at least this: five standard errors below the threshold.
LIKELY = 0.6


def shingles(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of the shingles; fewer words than ``SHINGLE`` are one shingle, none are none."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64), np.ones(1, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - SHINGLE + 1
    code = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        code = code * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    return np.unique(mix64(code), return_counts=True)


def signature(hashes: np.ndarray, weights: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The shingle with the first arrival in each register."""
    first, who = np.full(registers, np.inf), np.zeros(registers, np.uint64)
    active, at, drawn = hashes, np.zeros(len(hashes)), 0
    rate = weights.astype(np.float64)
    while len(active):
        # Few shingles need many arrivals to fill all registers: several are drawn at a time.
        step = max(1, int(1.5 * registers * np.log(registers) / len(active)) if not np.isfinite(first).all() else 1)
        keys = mix64(active[:, None] + (np.arange(drawn, drawn + step, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))[None, :])
        times = at[:, None] + np.cumsum(-np.log(uniform(keys, 1)) / rate[:, None], axis=1)
        place = (mix64(keys ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(registers)).astype(np.int64)
        t, r = times.ravel(), place.ravel()
        owner = np.repeat(np.arange(len(active)), step)
        better = np.flatnonzero(t < first[r])
        better = better[np.argsort(-t[better], kind="stable")]
        first[r[better]] = t[better]
        who[r[better]] = active[owner[better]]
        at, drawn = times[:, -1], drawn + step
        still = at < first.max()
        active, at, rate = active[still], at[still], rate[still]
    return who


def signatures(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The signature by counts and that of the set; they are one if nothing is repeated."""
    counted = signature(hashes, counts)
    return counted, counted if not len(counts) or counts.max() == 1 else signature(hashes, np.ones_like(counts))


def all_band_keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Keys of the bands of both signatures, each once."""
    counted, plain = signatures(hashes, counts)
    return band_keys(counted) if plain is counted else np.unique(np.concatenate([band_keys(counted), band_keys(plain)]))


def band_keys(found: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        keys = mix64(keys + found.reshape(BANDS, ROWS)[:, k])
    return keys.view(np.int64)


def words_lower(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split() if text else []


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(plain Jaccard of the sets, probability Jaccard of the counts); ``a`` and ``b`` are sorted hashes."""
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0, 0.0
    plain = len(both) / (len(a) + len(b) - len(both))
    if x.max() == 1 and y.max() == 1:
        return plain, plain
    only_x, only_y = x.sum() - x[i].sum(), y.sum() - y[j].sum()
    ratio, which = np.unique(x[i] / y[j], return_inverse=True)
    total = np.array([only_x + q * only_y + np.maximum(x[i], q * y[j]).sum() for q in ratio])
    return plain, float((x[i] / total[which]).sum())


def linked(bags: list[tuple[np.ndarray, np.ndarray]], left: np.ndarray, right: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links that join all texts of a class: between ``left`` and ``right`` texts, or within if they are the same."""
    parent = list(range(len(bags)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    both = [signatures(*bag) for bag in bags]
    prints, plain = np.stack([c for c, _ in both]), np.stack([p for _, p in both])
    found = []
    same = left is right
    likely = []
    for n, i in enumerate(left):
        others = right[n + 1 :] if same else right
        if len(others):
            share = np.maximum((prints[others] == prints[i]).mean(axis=1), (plain[others] == plain[i]).mean(axis=1))
            keep = np.flatnonzero(share >= LIKELY)
            likely.append(np.stack([-share[keep], np.full(len(keep), i), others[keep]], axis=1))
    pairs = np.concatenate(likely) if likely else np.empty((0, 3))
    for _, i, j in pairs[np.argsort(pairs[:, 0], kind="stable")]:
        i, j = int(i), int(j)
        if root(i) != root(j) and max(probability_jaccard(*bags[i], *bags[j])) >= threshold:
            parent[root(i)] = root(j)
            found.append((i, j))
    return found


def row_hash(docs: DataFrame) -> Column:
    """A hash over all columns, which tells rows of one ``doc_id`` apart."""
    return F.xxhash64(*(c.cast("string") for c in columns_of(docs)))


def classes(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, row_hash, digest, class_id``: every row of ``docs`` with the least ``doc_id`` of its class.

    Texts of fewer than five words are one shingle and match only the same words. A text that is null or has no words
    is like no other: its class is its own ``doc_id`` and its digest null. Null ids are not counted as the least; a
    class of null ids has a null ``class_id``. Case and the kind of space between words do not matter. Repeated rows
    are in one class. No rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash(docs).alias("row_hash"), F.col(text).alias("text"))

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in chunks_of(pdf, BATCH_BYTES):
                digests, bands = [], []
                for t in part["text"]:
                    words = words_lower(t)
                    digests.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                    bands.append(all_band_keys(*shingles(words)) if words else None)
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].astype("Int64"),
                        "row_hash": part["row_hash"],
                        "digest": digests,
                        "bands": bands,
                    }
                )

    schema = "doc_id long, row_hash long, digest binary, bands array<long>"
    known = staged(rows.mapInPandas(sketched, schema), "sketches")
    texts = known.filter("digest is not null").groupBy("digest").agg(
        F.first("bands").alias("bands"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash")).alias("one"),
    )
    texts = staged(texts.select("digest", "bands", "one.doc_id", "one.row_hash"), "texts")
    in_bands = texts.select("digest", F.explode("bands").alias("band"))
    centres = in_bands.groupBy("band").agg(F.min("digest").alias("centre"), F.count(F.lit(1)).alias("n"))
    centres = centres.filter("n > 1").select(F.col("band").alias("_band"), "centre")
    raw = components(
        in_bands.join(centres, F.col("band") == F.col("_band")).select(F.col("digest").alias("a"), F.col("centre").alias("b"))
    )

    sizes = raw.groupBy("root").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("root", "_root")
    half = MEET // 2
    blocks = F.when(F.col("_n") <= MEET, F.lit(1)).otherwise(F.ceil(F.col("_n") / half)).cast("int")
    members = raw.join(sizes, F.col("root") == F.col("_root")).select("node", "root", blocks.alias("_blocks"))
    wanted = texts.select("digest", "doc_id", "row_hash").join(members, F.col("digest") == F.col("node"))
    wanted = staged(
        wanted.select(
            F.col("doc_id").alias("_id"),
            F.col("row_hash").alias("_hash"),
            "digest",
            "root",
            "_blocks",
            F.pmod(F.xxhash64("digest"), F.col("_blocks")).cast("int").alias("_block"),
        ),
        "members",
    )
    slots = max(1, -(-wanted.count() // MEET))
    met = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_hash") == F.col("_hash")))
    met = met.select("digest", "root", "_blocks", "_block", "text")

    def bagged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in chunks_of(pdf, BATCH_BYTES):
                found = [shingles(words_lower(t)) for t in part["text"]]
                yield part.drop(columns="text").assign(
                    hashes=[h.tobytes() for h, _ in found], counts=[c.astype(np.int32).tobytes() for _, c in found]
                )

    bags = met.mapInPandas(bagged, "digest binary, root binary, _blocks int, _block int, hashes binary, counts binary")
    # A block meets itself and every other one of its component.
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    paired = bags.withColumn("_other", other).select(
        "*",
        F.least("_block", "_other").alias("_i"),
        F.greatest("_block", "_other").alias("_j"),
    )
    small = F.col("_blocks") == 1
    task = F.when(small, F.pmod(F.xxhash64("root"), F.lit(slots))).otherwise(F.xxhash64("root", "_i", "_j"))

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for (_, i, j), group in pdf.groupby(["root", "_i", "_j"], sort=False):
            group = group.drop_duplicates("digest").sort_values("digest")
            digests, block = group["digest"].tolist(), group["_block"].to_numpy()
            bags = [
                (np.frombuffer(h, np.uint64), np.frombuffer(c, np.int32).astype(np.int64))
                for h, c in zip(group["hashes"], group["counts"])
            ]
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if i == j:
                right = left
            rows += [(digests[a], digests[b]) for a, b in linked(bags, left, right, threshold)]
        return pd.DataFrame(rows, columns=["a", "b"])

    sure = paired.withColumn("_task", task).groupBy("_task").applyInPandas(links, "a binary, b binary")
    roots = components(sure).withColumnsRenamed({"node": "_node", "root": "_root"})
    labelled = known.select("doc_id", "row_hash", "digest").join(roots, F.col("digest") == F.col("_node"), "left")
    labelled = staged(
        labelled.select("doc_id", "row_hash", "digest", F.coalesce("_root", "digest").alias("_class")), "labelled"
    )
    least = labelled.filter("_class is not null").groupBy("_class").agg(F.min("doc_id").alias("_least"))
    least = least.withColumnRenamed("_class", "_of")
    out = labelled.join(least, F.col("_class") == F.col("_of"), "left")
    class_id = F.when(F.col("_class").isNull(), F.col("doc_id")).otherwise(F.col("_least"))
    return out.select("doc_id", "row_hash", "digest", class_id.alias("class_id"), F.col("_class").alias("class_key"))


def deduplicated(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each class, that with the least ``doc_id``; rows without words all stay.

    The columns are those of ``docs``, whatever their names.
    """
    found = staged(classes(docs, text, threshold), "classes")
    key, hashed, id_, hash_, rows = unused(docs, "_key", "_row_hash", "_id", "_hash", "_rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash")
    best = found.filter("class_key is not null").groupBy("class_key").agg(F.min(order).alias("one"))
    best = best.select(F.col("one.doc_id").alias(id_), F.col("one.row_hash").alias(hash_))
    copies = found.groupBy("doc_id", "row_hash").agg(F.count(F.lit(1)).alias(rows))
    best = best.join(copies, F.col(id_).eqNullSafe(F.col("doc_id")) & (F.col(hash_) == F.col("row_hash")))
    best = best.select(id_, hash_, rows)
    own = docs.select("*", F.col("doc_id").cast("long").alias(key), row_hash(docs).alias(hashed))
    met = own.join(best, F.col(key).eqNullSafe(F.col(id_)) & (F.col(hashed) == F.col(hash_)))
    once = met.filter(F.col(rows) == 1).unionByName(met.filter(F.col(rows) > 1).dropDuplicates([id_, hash_]))
    silent = docs.filter(F.col(text).isNull() | ~F.lower(text).rlike(r"[^\x20\x09-\x0D]"))
    return once.select(*columns_of(docs)).unionByName(silent.select(*columns_of(docs)))
