"""Document fingerprints by consistent weighted sampling.

A text is a bag of terms with weights (how often they occur). For each of ``SAMPLES`` samples every term draws two
gamma numbers and a uniform one from its hash, which give the largest reachable weight step below its weight and a
distance; the nearest term and its step are the sample. Two bags have the same sample with a probability equal to their
generalised Jaccard similarity, so the share of equal samples estimates it.

Terms are runs of non-space bytes, cut every ``TERM_BYTES`` bytes from their start so that scripts without spaces have
terms too. Nothing is lower-cased: equal texts have equal fingerprints, and other texts are told apart.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelark.llm.common import chunks_of, mix64

SAMPLES = 64
TERM_BYTES = 64
BATCH_BYTES = 12_000_000
PARTITION_CHARS = 32_000_000
NO_TERMS = "0000" * SAMPLES


def terms_of(text: bytes) -> Counter[bytes]:
    found = Counter(text.split())
    for term in [t for t in found if len(t) > TERM_BYTES]:
        times = found.pop(term)
        for start in range(0, len(term), TERM_BYTES):
            found[term[start : start + TERM_BYTES]] += times
    return found


def bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of distinct terms, then per text and term in order of texts: text number, term number, count)."""
    numbers: dict[bytes, int] = {}
    sizes, term, counts = [], [], []
    for text in texts:
        found = terms_of(text)
        sizes.append(len(found))
        term.extend([numbers.setdefault(t, len(numbers)) for t in found])
        counts.extend(found.values())
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
    owner = np.repeat(np.arange(len(texts)), sizes)
    return hashes, owner, np.array(term, np.int64), np.array(counts, np.int64)


def _ordered(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the floats, in the upper half of 64 bits."""
    bits = x.astype(np.float32).view(np.uint32)
    bits = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))
    return bits.astype(np.uint64) << np.uint64(32)


@lru_cache(maxsize=4)
def gamma_quantiles(bits: int) -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2 in the middle of ``2**bits`` equal steps."""
    x = np.geomspace(1e-6, 40, 200_000)
    share = -np.expm1(-x) - x * np.exp(-x)
    return np.interp((np.arange(1 << bits) + 0.5) / (1 << bits), share, x).astype(np.float32)


def samples(texts: list[bytes]) -> np.ndarray:
    """``SAMPLES`` 16-bit numbers for each text; zeros for a text without terms."""
    terms, owner, term, count = bags(texts)
    out = np.zeros((len(texts), SAMPLES), np.uint16)
    if not len(terms):
        return out
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    known = owner[starts]
    heavy = np.flatnonzero(count > 1)
    weight = np.log(count[heavy]).astype(np.float32)
    heavy_term = term[heavy]
    r_of, log_c_of = gamma_quantiles(16), np.log(gamma_quantiles(18))
    code = mix64(~terms) & np.uint64(0xFFFFFFFF)
    for k in range(SAMPLES):
        bits = mix64(terms + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64))
        r, log_c = r_of[bits & np.uint64(2**16 - 1)], log_c_of[bits >> np.uint64(16) & np.uint64(2**18 - 1)]
        beta = ((bits >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24)
        # Weight 1: step 0, so ln y = -r * beta.
        packed = (_ordered(log_c + r * beta - r) | code)[term]
        if len(heavy):
            hr, hb = r[heavy_term], beta[heavy_term]
            step = np.floor(weight / hr + hb)
            distance = log_c[heavy_term] - hr * (step - hb) - hr
            moved = mix64(code[heavy_term] + (step.astype(np.uint64) << np.uint64(32))) >> np.uint64(32)
            packed[heavy] = _ordered(distance) | np.where(step == 0, code[heavy_term], moved)
        out[known, k] = (np.minimum.reduceat(packed, starts) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def as_text(found: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in found]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples; texts without terms are alike."""
    return (a == b).mean(axis=1)


def fingerprinted(text: str = "text") -> Column:
    """The fingerprint of each whole text as hexadecimal text; null counts as empty."""

    @F.pandas_udf("string")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            parts = chunks_of(pd.DataFrame({"text": series}), BATCH_BYTES)
            yield pd.Series([p for part in parts for p in as_text(samples([(t or "").encode() for t in part["text"]]))])

    return prints(F.col(text))


def with_following(docs: DataFrame, partition_chars: int = PARTITION_CHARS) -> DataFrame:
    """Documents in partitions of about ``partition_chars``, descending by ``doc_id``, each partition followed by the
    document that comes after it (``_look`` 1); the first document follows the last.

    ``doc_id`` null comes last; rows with one ``doc_id`` are in order of the hash of their text. The partitions are
    ranges between quantiles of ``doc_id``, so that the text is shuffled once. Only the quantiles and the id that
    begins each partition are looked up before that.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    total, ids = rows.agg(F.sum(F.length("text")), F.count("doc_id")).first()
    parts = max(1, -(-(total or 0) // partition_chars))
    shares = [k / parts for k in range(1, parts)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 100 * parts)).first()[0] if shares and ids else []
    bounds = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf("int")
    def range_of(series: pd.Series) -> pd.Series:
        known = series.notna().to_numpy()
        out = np.full(len(series), len(bounds) + 1)
        ids = series[known].astype("int64").to_numpy()
        out[known] = len(bounds) - np.searchsorted(bounds, ids)
        return pd.Series(out.astype(np.int32))

    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ranged = rows.withColumn("_range", range_of("doc_id"))
    # One row for each range, so one for ``partition_chars`` characters of text: its largest id.
    heads = rows.select("doc_id").withColumn("_range", range_of("doc_id")).groupBy("_range").agg(F.max("doc_id").alias("_head"))
    over = Window.orderBy("_range")
    everything = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(
        "_head", F.coalesce(F.lag("_range").over(over), F.max("_range").over(everything)).alias("_before")
    )
    look = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("_head"))).select(
        "doc_id", "text", F.col("_before").alias("_range"), F.lit(1).alias("_look")
    )
    both = ranged.select("doc_id", "text", "_range", F.lit(0).alias("_look")).unionByName(look)
    # By range, not by hash, which would put several ranges in one partition and none in others.
    return both.repartitionByRange(int(parts), "_range").sortWithinPartitions("_range", "_look", *order)


PAIR = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by as many of the next document's first ones, or all it has."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text and how near they are, also to the next document's.

    A null text counts as empty; the fingerprint of an empty text is zeros, and two such are alike (1.0). A table of
    one document is followed by itself; no rows give no rows. Repeated rows follow one another.
    """

    def rows_of(pdf: pd.DataFrame, followed: np.ndarray) -> pd.DataFrame:
        """Rows of the documents marked in ``followed``, each of which the next row of ``pdf`` follows."""
        texts, at = pdf["text"].tolist(), np.flatnonzero(followed)
        new = [edited(texts[i], texts[i + 1]).encode() for i in at]
        # Edited texts have the terms of their neighbours, so all are sampled together.
        found = samples([t.encode() for t in texts] + new)
        own, changed = found[: len(texts)], found[len(texts) :]
        return pd.DataFrame(
            {
                "doc_id": pdf["doc_id"].iloc[at].astype("Int64").to_numpy(),
                "n_chars": [len(texts[i]) for i in at],
                "edited_sha256": [hashlib.sha256(t).hexdigest() for t in new],
                "fingerprint": as_text(own[at]),
                "edited_fingerprint": as_text(changed),
                "near_edited": likeness(own[at], changed),
                "near_next": likeness(own[at], own[at + 1]),
            }
        )

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            for part in chunks_of(batch, BATCH_BYTES // 2):
                pdf = part if held is None else pd.concat([held, part], ignore_index=True)
                same = (pdf["_range"] == pdf["_range"].shift(-1)) & (pdf["_look"] == 0)
                if same.any():
                    yield rows_of(pdf, same.to_numpy())
                held = pdf.iloc[-1:]

    return with_following(docs).mapInPandas(pairs, PAIR)
