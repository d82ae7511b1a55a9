"""Toxicity by averaged subword embeddings and a linear softmax.

A stretch of ``SEGMENT_WORDS`` words is the average of the embeddings of its hashed character n-grams, and two classes
are scored linearly from it; embeddings and classes are learned together. A misspelt word shares most n-grams with the
word it comes from. A document is as toxic as its most toxic stretch, so that a remark in a long text is not averaged
away.

Only documents are labelled. Stretches of clean ones are clean; those of toxic ones start as toxic, and after each
round the ones that the model finds clean are left out, so that what is common to all texts stops counting. Last, two
numbers are fitted that turn the largest stretch score into a probability, on whole documents that were set aside, with
each class as heavy as it is among all labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelark.llm.bytegrams import SPACE, grams, stream

BITS = 17
SIZES = (3, 4, 5)
SEGMENT_WORDS = 6
DIMENSIONS = 8
#: Characters whose n-grams are held as temporary arrays at once.
PIECE = 500_000
#: One in so many of the sampled documents is set aside for the probabilities.
ASIDE = 5


def pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Whole texts in lists of about ``PIECE`` characters, with each one's place in ``texts``.

    A longer text comes in several pieces, cut at a space where there is one, so its stretches begin anew there.
    """
    places, held, size = [], [], 0
    for place, text in enumerate(texts):
        text, start = text or "", 0
        while start < len(text):
            end = len(text)
            if end - start > PIECE:
                space = text.rfind(" ", start + 1, start + PIECE)
                end = space if space > 0 else start + PIECE
            if held and size + end - start > PIECE:
                yield np.array(places), held
                places, held, size = [], [], 0
            places.append(place)
            held.append(text[start:end])
            size += end - start
            start = end
    if held:
        yield np.array(places), held


def segments(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text of each segment, segment of each n-gram, n-gram): segments in order of their texts, each with n-grams."""
    data, owner = stream(texts)
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    word = np.cumsum(data == SPACE)
    first = word[np.searchsorted(owner, np.arange(len(texts)))]
    place = (owner.astype(np.int64) << 32) + (word - first[owner]) // SEGMENT_WORDS
    at, code = zip(*(grams(data, n, BITS) for n in SIZES))
    at, code = np.concatenate(at), np.concatenate(code)
    # The n-gram's last byte is a letter or the space after it; its second byte is always inside the word.
    found, segment = np.unique(place[np.minimum(at + 1, len(place) - 1)], return_inverse=True)
    return (found >> 32), segment, code


@dataclass(frozen=True)
class ToxicityModel:
    """``weights``: what each n-gram adds to the log-odds of a stretch it fills (``2**BITS`` numbers, half a MB)."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def largest(self, texts: list[str | None]) -> np.ndarray:
        """The largest log-odds of each text's stretches; minus infinity for a text without any n-gram."""
        out = np.full(len(texts), -np.inf)
        for places, held in pieces(texts):
            owner, segment, code = segments(held)
            total = np.bincount(segment, weights=self.weights[code], minlength=len(owner))
            mean = total / np.bincount(segment, minlength=len(owner))
            np.maximum.at(out, places[owner], mean + self.bias)
        return out

    def probability(self, texts: list[str | None]) -> np.ndarray:
        """Nothing speaks for a text without n-grams: its score is 0."""
        odds = self.largest(texts)
        known = np.isfinite(odds)
        found = 1 / (1 + np.exp(-np.clip(self.slope * np.where(known, odds, 0) + self.shift, -30, 30)))
        return np.where(known, found, 0.0)


def train(texts: list[str], labels: np.ndarray, seed: int = 7, rounds: int = 2, epochs: int = 2) -> tuple[np.ndarray, float]:
    """(weight of each n-gram, bias) by mini-batch gradients with per-parameter step sizes (Adagrad)."""
    rng = np.random.default_rng(seed)
    width = 1 << BITS
    embed = rng.normal(0, 0.1, (width, DIMENSIONS)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32), np.zeros(2, np.float32)
    squares = np.full(width, 1e-6, np.float32), np.full(out.shape, 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    owners, codes, counts = [np.empty(0, np.int64)], [np.empty(0, np.int32)], [np.empty(0, np.int64)]
    for places, held in pieces(texts):
        owner, segment, code = segments(held)
        owners.append(places[owner])
        codes.append(code[np.argsort(segment, kind="stable")].astype(np.int32))
        counts.append(np.bincount(segment, minlength=len(owner)))
    code, ends, target = np.concatenate(codes), np.cumsum(np.concatenate(counts)), labels[np.concatenate(owners)]
    del codes
    alive = np.ones(len(ends), bool)
    batch = 512
    for step in range(rounds):
        if step:
            weights = embed @ (out[:, 1] - out[:, 0])
            odds = np.empty(len(ends))
            for k in range(0, len(ends), PIECE // 32):
                cut = np.r_[ends[k - 1] if k else 0, ends[k : k + PIECE // 32]]
                odds[k : k + PIECE // 32] = np.add.reduceat(weights[code[cut[0] : cut[-1]]], cut[:-1] - cut[0]) / np.diff(cut)
            alive = (target == 0) | (odds + bias[1] - bias[0] > 0)
        for _ in range(epochs):
            chosen = rng.permutation(np.flatnonzero(alive))
            for k in range(0, len(chosen), batch):
                rows = np.sort(chosen[k : k + batch])
                starts = np.where(rows > 0, ends[rows - 1], 0)
                sizes = ends[rows] - starts
                flat = np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
                used, inverse = np.unique(code[flat], return_inverse=True)
                local = embed[used]
                cut = np.r_[0, np.cumsum(sizes)[:-1]]
                mean = np.add.reduceat(local[inverse], cut, axis=0) / sizes[:, None].astype(np.float32)
                logits = mean @ out + bias
                logits -= logits.max(axis=1, keepdims=True)
                p = np.exp(logits)
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(rows)), target[rows]] -= 1
                back = (p @ out.T) / sizes[:, None].astype(np.float32)
                spread = np.repeat(back, sizes, axis=0)
                grad = np.stack([np.bincount(inverse, spread[:, d], len(used)) for d in range(DIMENSIONS)], 1)
                steps = (grad.astype(np.float32), mean.T @ p, p.sum(axis=0))
                squares[0][used] += (steps[0] ** 2).mean(axis=1)
                squares[1][...] += steps[1] ** 2
                squares[2][...] += steps[2] ** 2
                embed[used] -= 0.4 * steps[0] / np.sqrt(squares[0][used])[:, None]
                out -= 0.1 * steps[1] / np.sqrt(squares[1])
                bias -= 0.1 * steps[2] / np.sqrt(squares[2])
    return (embed @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0])


def calibrated(odds: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve for weighted rows, by Newton steps with a small ridge."""
    x, w = np.stack([odds, np.ones_like(odds)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.array([1e-2, 1e-2])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, x.T @ (weight * (p - labels)) + ridge * (w - [1, 0]))
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 4000, sample_chars: int = 15_000_000) -> ToxicityModel:
    """Learn from ``labels`` (``doc_id, toxic``); the caller has left out what is held out.

    At most ``sample`` labelled documents of each class are used, those with the smallest hash of ``doc_id``, and of these
    the first whole ones that have at most ``sample_chars`` characters together, without those that have more than a
    fiftieth of it alone: the bound of what the training task holds and of the one broadcast. Null labels and ids are ignored; a document labelled more
    than once is toxic if one label says so; of documents that share an id, the least text is learned from. Without labels of both classes every score is near 0.
    """
    labelled = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id")
    labelled = labelled.agg(F.max((F.col("toxic") > 0).cast("int")).alias("_toxic")).withColumnRenamed("doc_id", "_id")
    of_class = {r["_toxic"]: r["count"] for r in labelled.groupBy("_toxic").count().collect()}
    by_hash = F.xxhash64("_id")
    some = [labelled.filter(F.col("_toxic") == k).orderBy(by_hash, "_id").limit(sample) for k in (0, 1)]
    chosen = F.broadcast(some[0].unionByName(some[1]))
    rows = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id"))
    # Of documents that share an id one counts, so there are at most two times ``sample`` rows from here on.
    rows = rows.groupBy("_id", "_toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    aside = F.pmod(by_hash, F.lit(ASIDE)) == 0
    # At most two times ``sample`` rows are added up here.
    before = Window.partitionBy("_toxic").orderBy(by_hash, "_id", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.filter(F.length("text") <= sample_chars // 50)
    rows = rows.withColumn("_chars", F.sum(F.length("text")).over(before)).filter(F.col("_chars") <= sample_chars)
    rows = rows.select("text", "_toxic", aside.alias("_aside")).repartition(1)

    def learned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat([*batches, pd.DataFrame({"text": [], "_toxic": [], "_aside": []})])
        pdf = pdf.sort_values(["_toxic", "text"], kind="stable")
        texts, y, aside = pdf["text"].tolist(), pdf["_toxic"].to_numpy("int64"), pdf["_aside"].to_numpy(bool)
        weights, bias, slope, shift = np.zeros(1 << BITS), -5.0, 1.0, 0.0
        if 0 < y.sum() < len(y):
            # Few labels are all learned from, and set aside as well.
            if min(y[aside].sum(), (1 - y[aside]).sum()) < 20:
                known = used = np.ones(len(y), bool)
            else:
                known, used = ~aside, aside
            weights, bias = train([t for t, k in zip(texts, known) if k], y[known])
            odds, marked = ToxicityModel(weights, bias).largest([t for t, k in zip(texts, used) if k]), y[used]
            odds, marked = odds[np.isfinite(odds)], marked[np.isfinite(odds)]
            heavy = np.array([of_class[k] / max((marked == k).sum(), 1) for k in (0, 1)])
            slope, shift = calibrated(odds, marked, heavy[marked] * len(marked) / sum(of_class.values()))
        yield pd.DataFrame({"w": [weights.astype("<f4").tobytes()], "bias": bias, "slope": slope, "shift": shift})

    found = rows.mapInPandas(learned, "w binary, bias double, slope double, shift double").first()
    return ToxicityModel(np.frombuffer(found["w"], "<f4").astype(np.float64), found["bias"], found["slope"], found["shift"])


def scored(model: ToxicityModel, text: str = "text") -> Column:
    """The probability of label 1, for whole texts; 0 for null and empty texts."""

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series(model.probability(series.tolist()))

    return probability(F.col(text))
