"""Language identification by the nearest centroid.

A text is a vector of hashed letter n-grams: logarithmic counts times inverse document frequency, at length one. Each
language has several centroids, found by clustering a bounded sample of its labelled texts (spherical k-means), since a
language is written in several manners. A text belongs to the language of the centroid with the largest cosine, and is
rejected where even that one is farther away than texts of the language of like length are. How far those are is
measured on texts set aside, which the centroids were not made of, and on their beginnings, since short texts are
farther away than long ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelark.llm.bytegrams import grams, has_letter, stream
from framelark.llm.common import chunks_of, sum_blobs

BITS = 14
SIZES = (2, 3)
UNKNOWN = "und"
BATCH_BYTES = 2_000_000
#: Texts longer than this are counted by themselves, so a slice of a batch has a bounded number of rows.
BATCH_DOCS = 128
#: Characters of the beginnings of texts set aside.
BEGINNINGS = (8, 16, 32, 64, 128, 256, 512, 1024)
#: A text's length band is the binary logarithm of how many of the hashed n-grams it has.
LENGTH_BANDS = BITS + 1
#: Of the texts set aside, the quantile that is the measure of far.
QUANTILE = 0.02
#: Every so many-th text of a language's sample is set aside.
SET_ASIDE = 4


def count_matrix(texts: list[str | None], bits: int = BITS) -> np.ndarray:
    """Counts of hashed n-grams, one row per text."""
    data, owner = stream(texts)
    width = 1 << bits
    out = np.zeros(len(texts) * width, np.float64)
    for n in SIZES:
        at, code = grams(data, n, bits)
        out += np.bincount(owner[at].astype(np.int64) * width + code, minlength=len(out))
    return out.reshape(len(texts), width)


def vectors(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors; a text without letters is a zero vector."""
    found = (np.log1p(count_matrix(texts)) * idf).astype(np.float32)
    length = np.linalg.norm(found, axis=1, keepdims=True)
    return np.divide(found, length, out=found, where=length > 0)


def sparse(v: np.ndarray) -> bytes:
    at = np.flatnonzero(v)
    return at.astype(np.uint16).tobytes() + v[at].tobytes()


def dense(blobs: list[bytes]) -> np.ndarray:
    out = np.zeros((len(blobs), 1 << BITS), np.float32)
    for row, blob in zip(out, blobs):
        n = len(blob) // 6
        row[np.frombuffer(blob, np.uint16, n)] = np.frombuffer(blob, np.float32, n, 2 * n)
    return out


def length_band(x: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(np.count_nonzero(x, axis=1), 1)).astype(np.int64)


def far(blobs: list[bytes], centroids: np.ndarray, at_once: int = 256) -> np.ndarray:
    """Low quantile of the cosines in each length band; a band without any has that of the next shorter one."""
    cosine, band = [], []
    for start in range(0, len(blobs), at_once):
        x = dense(blobs[start : start + at_once])
        cosine.append((x @ centroids.T).max(axis=1))
        band.append(length_band(x))
    cosine, band = np.concatenate(cosine), np.concatenate(band)
    out = np.zeros(LENGTH_BANDS)
    for b in range(LENGTH_BANDS):
        own = cosine[band == b]
        out[b] = np.quantile(own, QUANTILE) if len(own) else out[max(b - 1, 0)]
    return out


def clustered(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids; starts are far apart and depend on the rows alone."""
    starts = [x.mean(axis=0)]
    nearest = x @ (starts[0] / (np.linalg.norm(starts[0]) or 1))
    starts = []
    for _ in range(min(k, len(x))):
        starts.append(x[int(np.argmin(nearest))] if starts else x[int(np.argmax(nearest))])
        nearest = x @ starts[0] if len(starts) == 1 else np.maximum(nearest, x @ starts[-1])
    centroids = np.array(starts, np.float32)
    for _ in range(rounds):
        own = np.argmax(x @ centroids.T, axis=1)
        for c in range(len(centroids)):
            total = x[own == c].sum(axis=0)
            if (norm := np.linalg.norm(total)) > 0:
                centroids[c] = total / norm
    own = np.argmax(x @ centroids.T, axis=1)
    return centroids[[bool((own == c).any()) for c in range(len(centroids))]]


@dataclass(frozen=True)
class LanguageModel:
    """``centroids`` are unit rows of 128 kB; ``langs`` and ``floors`` (by length band) belong to them."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: tuple[str, ...]
    floors: np.ndarray

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        out = pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "rejected": True})
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        if known and len(self.langs):
            x = vectors([texts[i] for i in known], self.idf)
            cosine = x.astype(np.float64) @ self.centroids.T
            best = np.argmax(cosine, axis=1)
            score = np.clip(cosine[np.arange(len(known)), best], 0.0, 1.0)
            out.loc[known, "lang_pred"] = np.array(self.langs, object)[best]
            out.loc[known, "score"] = score
            out.loc[known, "rejected"] = score < self.floors[best, length_band(x)]
        elif known:
            out.loc[known, "rejected"] = False
        return out


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    sample: int = 1500,
    clusters: int = 4,
    reject: float = 0.6,
) -> LanguageModel:
    """Learn from rows with a language and a text with letters; other rows are left out.

    Document frequencies are counted over all of them. Centroids come from ``sample`` different texts of each language, those
    with the smallest hash: that bound keeps what one task clusters at ``sample`` vectors of 64 kB. Every fourth of them is set
    aside (all are used for both if there are fewer than eight). A text is rejected below ``reject`` times a low
    quantile of the cosines of texts set aside in its length band. Without rows the model knows no language: it
    answers ``und`` and rejects only texts without letters. The model in the driver has ``clusters`` vectors a language.
    """
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((1 << BITS) + 1)
        for pdf in batches:
            for part in slices(pdf):
                total[:-1] += (count_matrix(part["text"].tolist()) > 0).sum(axis=0)
                total[-1] += len(part)
        yield pd.DataFrame({"n": [total.tobytes()]})

    summed = sum_blobs(rows.mapInPandas(frequencies, "n binary"), [], "n").first()
    counts = np.frombuffer(summed[0]) if summed else np.zeros((1 << BITS) + 1)
    idf = np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1

    # Hashes are ranked once for each text, so copies of one text do not fill the sample.
    hashed = rows.withColumn("_hash", F.xxhash64("text"))
    first = Window.partitionBy("_lang").orderBy("_of")
    wanted = hashed.select(F.col("lang").alias("_lang"), F.col("_hash").alias("_of")).distinct()
    wanted = wanted.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= sample)
    # At most ``sample`` rows a language.
    met = hashed.join(F.broadcast(wanted), (F.col("lang") == F.col("_lang")) & (F.col("_hash") == F.col("_of")))
    chosen = met.groupBy("lang", "n").agg(F.min("text").alias("text"))

    def embedded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in slices(pdf):
                kept = [sparse(v) for v in vectors(part["text"].tolist(), idf)]
                yield pd.DataFrame({"lang": part["lang"].to_numpy(), "v": kept, "n": part["n"].to_numpy(), "chars": 0})
                aside = part[part["n"] % SET_ASIDE == 0] if len(part) else part
                for chars in BEGINNINGS:
                    begun = aside[aside["text"].str.len() > chars]
                    begun = begun.assign(text=begun["text"].str[:chars])
                    begun = begun[[has_letter(t) for t in begun["text"]]] if len(begun) else begun
                    kept = [sparse(v) for v in vectors(begun["text"].tolist(), idf)] if len(begun) else []
                    yield pd.DataFrame({"lang": begun["lang"].to_numpy(), "v": kept, "n": begun["n"].to_numpy(), "chars": chars})

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        whole, aside = pdf["chars"] == 0, pdf["n"] % SET_ASIDE == 0
        few = whole.sum() < 2 * SET_ASIDE
        found = clustered(dense(sorted(pdf["v"][whole & (~aside | few)])), clusters)
        floors = far(pdf["v"][aside | few].tolist(), found)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "v": [c.tobytes() for c in found], "floors": [floors.tobytes()] * len(found)})

    model = (
        chosen.mapInPandas(embedded, "lang string, v binary, n int, chars int")
        .groupBy("lang")
        .applyInPandas(centroids, "lang string, v binary, floors binary")
        .collect()
    )
    model.sort(key=lambda r: (r["lang"], bytes(r["v"])))
    found = np.array([np.frombuffer(r["v"], np.float32) for r in model], np.float64).reshape(len(model), 1 << BITS)
    floors = np.array([np.frombuffer(r["floors"]) for r in model]).reshape(len(model), LENGTH_BANDS) * reject
    return LanguageModel(idf, found, tuple(r["lang"] for r in model), floors)


def slices(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for part in chunks_of(pdf, BATCH_BYTES):
        for start in range(0, len(part), BATCH_DOCS):
            yield part.iloc[start : start + BATCH_DOCS]


def predicted(model: LanguageModel, text: str = "text") -> Column:
    """A struct ``lang_pred, score, rejected`` for each text.

    ``und`` with score 0, rejected, if the text is null, empty or has no letter. The score is the cosine, 0 to 1.
    """

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            parts = [model.predict(p["text"].tolist()) for p in slices(pd.DataFrame({"text": series}))]
            yield pd.concat(parts, ignore_index=True) if parts else model.predict([])

    return answers(F.col(text))
