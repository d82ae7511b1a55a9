"""Language model scores by a hashed maximum-entropy model with a class-factored softmax.

The probability of a token is that of its group of word forms (endings that occur in like company), times that of its
band of frequency in the group, times its share of that class. The first two factors are softmaxes whose scores are
sums of hashed n-gram and skip features of what came before; the third has the word as its only feature, so that its
best weight is known: the logarithm of its count. The end of a text and all unknown words are groups of their own, so
the model spreads its mass over the same outcomes as the counts do: known tokens and one unknown.

While learning, a token is seen as if its own occurrence had not been counted: a word that occurs once teaches how
likely an unknown one is.

Texts are encoded once, in chunks of bounded size that are rows of a table in the shared folder. Words are counted by
buckets of their hash over all chunks, and each chunk gets the counts of its own words back; no vocabulary is held
anywhere as a whole. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.llm.common import chunks_of, mix64, squeezed, summed, unsqueezed
from framelark.session import staged

CHUNK_BYTES = 4_000_000
#: Distinct (chunk, word) pairs counted in one task.
BUCKET_WORDS = 500_000
FORMS = 1024
GROUPS = 8
#: Least counts, then least shares of all tokens, of the bands of frequency.
COUNT_BANDS = (1, 2, 4)
SHARE_BANDS = (1e-5, 1e-4, 1e-3)
BANDS = len(COUNT_BANDS) + len(SHARE_BANDS)
CLASSES = 2 + GROUPS * BANDS
END, UNKNOWN = 0, 1
#: Words with at least this share of all tokens are features by themselves, others by their class.
FEATURE_SHARE = 2e-5
FEATURE_BITS = 14
#: Training runs through all chunks once, in as many parts; the weights of all tasks are averaged after each.
ROUNDS = 4
BATCH = 2048
#: Tokens whose features are held at a time; a longer document is a block of its own.
BLOCK = 200_000


# Encoding


def encoded(docs: DataFrame, held_out: Column, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk: documents, token numbers within the chunk, and hash, form and training count of each word."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, n = TaskContext.get().partitionId(), 0
        for pdf in batches:
            for part in chunks_of(pdf, chunk_bytes):
                numbers: dict[bytes, int] = {b"": END}
                number, tokens, sizes = numbers.setdefault, [], []
                for words in part["text"]:
                    found = [number(w, len(numbers)) for w in (words or "").encode().lower().split()]
                    tokens += found
                    tokens.append(END)
                    sizes.append(len(found) + 1)
                tokens, sizes = np.array(tokens, np.int32), np.array(sizes, np.int32)
                held = part["held_out"].to_numpy(bool)
                counts = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(numbers))
                ids = part["doc_id"]
                yield pd.DataFrame(
                    {
                        "chunk": [f"{task}-{n}"],
                        "n_words": [len(numbers)],
                        "n_train": [int(sizes[~held].sum())],
                        "doc_ids": [ids.fillna(0).astype("int64").to_numpy().tobytes()],
                        "no_id": [ids.isna().to_numpy().astype(np.uint8).tobytes()],
                        "held": [held.astype(np.uint8).tobytes()],
                        "sizes": [sizes.tobytes()],
                        "tokens": [squeezed(tokens)],
                        "hashes": [np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64).tobytes()],
                        "forms": [squeezed(np.fromiter((xxhash.xxh32_intdigest(w[-3:]) % FORMS for w in numbers), np.uint16))],
                        "counts": [squeezed(counts.astype(np.int64))],
                    }
                )
                n += 1

    schema = (
        "chunk string, n_words long, n_train long, doc_ids binary, no_id binary, held binary, sizes binary, "
        "tokens binary, hashes binary, forms binary, counts binary"
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    return staged(rows.mapInPandas(encode, schema), "chunks")


def band_of(counts: np.ndarray, total: float) -> np.ndarray:
    """Band of frequency of each count, -1 for 0."""
    least = [*COUNT_BANDS, *(max(COUNT_BANDS[-1] + k + 1, share * total) for k, share in enumerate(SHARE_BANDS))]
    return np.searchsorted(least, counts, side="right") - 1


def counted(chunks: DataFrame, n_words: int, total: int) -> tuple[DataFrame, int, np.ndarray]:
    """(``chunks`` with the training count of each word over all chunks, distinct training words, counts by form and band)."""
    buckets = max(1, -(-n_words // BUCKET_WORDS))

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for chunk, hashes, forms, counts in zip(pdf["chunk"], pdf["hashes"], pdf["forms"], pdf["counts"]):
                h, f, c = np.frombuffer(hashes, np.uint64), unsqueezed(forms, np.uint16), unsqueezed(counts, np.int64)
                bucket = (h % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                parts = [order[a:b] for a, b in zip(cuts, cuts[1:])]
                kept = [k for k, p in enumerate(parts) if len(p)]
                yield pd.DataFrame(
                    {
                        "bucket": kept,
                        "chunk": chunk,
                        "word": [squeezed(parts[k].astype(np.int32)) for k in kept],
                        "hashes": [h[parts[k]].tobytes() for k in kept],
                        "forms": [squeezed(f[parts[k]]) for k in kept],
                        "counts": [squeezed(c[parts[k]]) for k in kept],
                    }
                )

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = np.frombuffer(b"".join(pdf["hashes"]), np.uint64)
        forms = np.concatenate([unsqueezed(f, np.uint16) for f in pdf["forms"]])
        counts = np.concatenate([unsqueezed(c, np.int64) for c in pdf["counts"]])
        number, distinct = pd.factorize(hashes)
        sums = np.bincount(number, counts, len(distinct)).astype(np.int64)
        form = np.zeros(len(distinct), np.int64)
        form[number] = forms
        known = (sums > 0) & (distinct != np.uint64(xxhash.xxh3_64_intdigest(b"")))
        cell = form[known] * BANDS + band_of(sums[known], total)
        by_cell = np.bincount(cell, sums[known], FORMS * BANDS)
        cuts = np.cumsum([len(h) // 8 for h in pdf["hashes"]])[:-1]
        often = np.where(sums >= max(FEATURE_SHARE * total, 3), distinct, np.uint64(0))
        summary = np.r_[float((sums > 0).sum()), by_cell].tobytes()
        out = pd.DataFrame(
            {
                "chunk": pdf["chunk"],
                "word": pdf["word"],
                "sums": [squeezed(m) for m in np.split(sums[number], cuts)],
                "often": [squeezed(m) for m in np.split(often[number], cuts)],
            }
        )
        return pd.concat([out, pd.DataFrame({"chunk": [None], "word": [None], "sums": [summary], "often": [None]})])

    split = chunks.select("chunk", "hashes", "forms", "counts").mapInPandas(
        dealt, "bucket int, chunk string, word binary, hashes binary, forms binary, counts binary"
    )
    found = staged(split.groupBy("bucket").applyInPandas(added, "chunk string, word binary, sums binary, often binary"), "counts")
    summary = summed(found.filter("chunk is null"), "sums")
    if summary is None:
        summary = np.zeros(1 + FORMS * BANDS)

    def placed(pdf: pd.DataFrame) -> pd.DataFrame:
        word = np.concatenate([unsqueezed(w, np.int32) for w in pdf["word"]])
        sums, often = np.zeros(len(word), np.int64), np.zeros(len(word), np.uint64)
        sums[word] = np.concatenate([unsqueezed(s, np.int64) for s in pdf["sums"]])
        often[word] = np.concatenate([unsqueezed(s, np.uint64) for s in pdf["often"]])
        return pd.DataFrame({"_chunk": pdf["chunk"].iloc[:1], "sums": [squeezed(sums)], "often": [squeezed(often)]})

    back = found.filter("chunk is not null").groupBy("chunk").applyInPandas(placed, "_chunk string, sums binary, often binary")
    joined = chunks.drop("counts", "n_words", "hashes").join(back, F.col("chunk") == F.col("_chunk")).drop("_chunk")
    return staged(joined, "counted"), int(summary[0]), summary[1:].reshape(FORMS, BANDS)


# Word forms


def followers(chunks: DataFrame) -> np.ndarray:
    """How often each form follows each other one in training texts."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(FORMS * FORMS, np.float32)
        for pdf in batches:
            for tokens, forms, held, sizes in zip(pdf["tokens"], pdf["forms"], pdf["held"], pdf["sizes"]):
                train = np.repeat(np.frombuffer(held, np.uint8) == 0, np.frombuffer(sizes, np.int32))
                t = unsqueezed(tokens, np.int32)
                f = unsqueezed(forms, np.uint16).astype(np.int64)[t]
                good = train[:-1] & (t[:-1] != END) & (t[1:] != END)
                total += np.bincount(f[:-1][good] * FORMS + f[1:][good], minlength=FORMS * FORMS).astype(np.float32)
        yield pd.DataFrame({"n": [total.tobytes()]})

    rows = chunks.select("tokens", "forms", "held", "sizes").mapInPandas(pairs, "n binary")
    found = summed(rows, "n", "<f4")
    return np.zeros((FORMS, FORMS)) if found is None else found.reshape(FORMS, FORMS).astype(np.float64)


def form_groups(pairs: np.ndarray, rounds: int = 30) -> np.ndarray:
    """A group for each form: k-means over the forms before and after it, by cosine, weighted by frequency."""
    weight = pairs.sum(axis=1) + pairs.sum(axis=0)
    after = pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1)
    before = (pairs / np.maximum(pairs.sum(axis=0, keepdims=True), 1)).T
    x = np.sqrt(np.hstack([after, before]))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    starts = [int(np.argmax(weight))]
    near = x @ x[starts[0]]
    for _ in range(GROUPS - 1):
        starts.append(int(np.argmax(np.sqrt(weight) * np.maximum(0, 1 - near))))
        near = np.maximum(near, x @ x[starts[-1]])
    centres = x[starts]
    group = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        group = np.argmax(x @ centres.T, axis=1)
        for g in range(GROUPS):
            total = (x[group == g] * np.sqrt(weight[group == g])[:, None]).sum(axis=0)
            if (norm := np.linalg.norm(total)) > 0:
                centres[g] = total / norm
    return group


# The model


def log_softmax(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Logarithms of the probabilities of the outcomes; ``rows`` has the weight rows of each token's features."""
    scores = weights[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        scores += weights[rows[:, k]]
    scores -= scores.max(axis=1, keepdims=True)
    scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
    return scores


def descend(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, goal: np.ndarray, rate: float = 0.5) -> None:
    """Mini-batch gradient steps in place; a row's steps shrink with the gradients it has had."""
    for start in range(0, len(rows), BATCH):
        part, wanted = rows[start : start + BATCH], goal[start : start + BATCH]
        slope = np.exp(log_softmax(weights, part))
        slope[np.arange(len(part)), wanted] -= 1
        flat = part.ravel()
        order = np.argsort(flat)
        cut = np.flatnonzero(np.r_[True, flat[order][1:] != flat[order][:-1]])
        used = flat[order[cut]]
        grad = np.add.reduceat(slope[order // part.shape[1]], cut, axis=0)
        squares[used] += np.einsum("ij,ij->i", grad, grad)
        weights[used] -= grad * (rate / np.sqrt(squares[used]))[:, None]


@dataclass
class MaxentModel:
    """``groups_of``: scores of the groups, one row for each hashed feature and one for none; ``bands_of``: scores of the
    bands, one row for each feature and group. Their sizes do not depend on the corpus."""

    total: int
    distinct: int
    groups: np.ndarray
    class_sums: np.ndarray
    groups_of: np.ndarray
    bands_of: np.ndarray

    def classes(self, forms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Class of each word; the first word of a chunk is the end of a text."""
        band = band_of(counts, self.total)
        out = np.where(band >= 0, 2 + self.groups[forms] * BANDS + np.maximum(band, 0), UNKNOWN)
        out[0] = END
        return out

    def features(self, often: np.ndarray, forms: np.ndarray, counts: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Rows of ``weights`` for each token: word before, two before, the pair, one skipped, two skipped, three classes."""
        kind = self.classes(forms, counts).astype(np.uint64)
        kind[kind == UNKNOWN] = CLASSES + self.groups[forms[kind == UNKNOWN]].astype(np.uint64)
        symbol = mix64(np.where(often > 0, often, kind))[tokens]
        kind = mix64(kind + np.uint64(977))[tokens]
        ends = np.cumsum(sizes)
        place = np.arange(len(tokens)) - np.repeat(ends - sizes, sizes)

        def back(x: np.ndarray, k: int) -> np.ndarray:
            out = np.zeros_like(x)
            out[k:] = x[:-k] if k < len(x) else x[:0]
            out[place < k] = np.uint64(k)
            return out

        one, two, three = (back(symbol, k) for k in (1, 2, 3))
        shape = back(kind, 1) * np.uint64(3) + back(kind, 2) * np.uint64(5) + back(kind, 3) * np.uint64(7)
        codes = (one + np.uint64(11), one * np.uint64(3) + two + np.uint64(12), two + np.uint64(13), three + np.uint64(14), shape)
        shift = np.uint64(64 - FEATURE_BITS)
        always = np.full(len(tokens), 1 << FEATURE_BITS, np.int32)
        return np.stack([*((mix64(c) >> shift).astype(np.int32) for c in codes), always], axis=1)

    @staticmethod
    def factors(features: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(group of each token, tokens that have a band, their rows of ``bands_of``, their bands)."""
        banded = np.flatnonzero(kind > UNKNOWN)
        group, band = np.divmod(kind[banded] - 2, BANDS)
        first = kind.copy()
        first[banded] = 2 + group
        return first, banded, features[banded] * np.int32(GROUPS) + group[:, None].astype(np.int32), band

    def class_log(self, features: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of each token's class."""
        out = np.empty(len(kind))
        for start in range(0, len(kind), BATCH):
            cut = slice(start, start + BATCH)
            first, banded, rows, band = self.factors(features[cut], kind[cut])
            found = log_softmax(self.groups_of, features[cut])[np.arange(len(first)), first].astype(np.float64)
            found[banded] += log_softmax(self.bands_of, rows)[np.arange(len(band)), band]
            out[cut] = found
        return out


def words_in(row: object) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of frequent words or 0, form, count) of each word of a chunk."""
    return unsqueezed(row.often, np.uint64), unsqueezed(row.forms, np.uint16), unsqueezed(row.sums, np.int64)


def blocks_of(row: object) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(which documents, their tokens, their sizes): a chunk in blocks of about ``BLOCK`` tokens."""
    tokens, sizes = unsqueezed(row.tokens, np.int32), np.frombuffer(row.sizes, np.int32)
    ends = np.cumsum(sizes, dtype=np.int64)
    number = (ends - sizes) // BLOCK
    cuts = [*np.flatnonzero(np.r_[True, number[1:] != number[:-1]]), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        yield slice(a, b), tokens[ends[a] - sizes[a] : ends[b - 1]], sizes[a:b]


def fit(chunks: DataFrame, total: int, distinct: int, by_form: np.ndarray, groups: np.ndarray) -> MaxentModel:
    """Learn the class weights from every training token once."""
    sums = np.zeros(CLASSES)
    np.add.at(sums, 2 + groups[:, None] * BANDS + np.arange(BANDS), by_form)
    width = (1 << FEATURE_BITS) + 1
    shapes = (width, 2 + GROUPS), (width * GROUPS, BANDS)
    weights = [np.zeros(shape, np.float32) for shape in shapes]
    squares = [np.ones(shape[0], np.float32) for shape in shapes]
    rows = chunks.select("chunk", "often", "forms", "sums", "tokens", "sizes", "held")
    part = F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS))
    for k in range(ROUNDS):
        start = [*weights, *squares]

        def steps(batches: Iterator[pd.DataFrame], start: list[np.ndarray] = start) -> Iterator[pd.DataFrame]:
            one, two, seen_one, seen_two = own = [a.copy() for a in start]
            model, count = MaxentModel(total, distinct, groups, sums, one, two), 0
            for pdf in batches:
                for row in pdf.itertuples():
                    often, forms, counts = words_in(row)
                    seen_once_less = model.classes(forms, np.maximum(counts - 1, 0))
                    held = np.frombuffer(row.held, np.uint8)
                    for docs, tokens, sizes in blocks_of(row):
                        train = np.repeat(held[docs] == 0, sizes)
                        kind = seen_once_less[tokens][train]
                        features = model.features(often, forms, counts, tokens, sizes)[train]
                        first, _, banded_rows, band = model.factors(features, kind)
                        descend(one, seen_one, features, first)
                        descend(two, seen_two, banded_rows, band)
                        count += len(kind)
            if count:
                moved = [((a - b) * np.float32(count)).ravel() for a, b in zip(own, start)]
                yield pd.DataFrame({"w": [np.concatenate([[count], *moved]).astype("<f4").tobytes()]})

        found = summed(rows.filter(part == k).drop("chunk").mapInPandas(steps, "w binary"), "w", "<f4")
        if found is not None:
            moved = np.split(found[1:] / found[0], np.cumsum([a.size for a in start])[:-1])
            found = [a + m.reshape(a.shape) for a, m in zip(start, moved)]
            weights, squares = found[:2], found[2:]
    return MaxentModel(total, distinct, groups, sums, *weights)


def scores(docs: DataFrame, held_out: Column, text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    Learns from the rows for which ``held_out`` is false. A null text is empty: one token, its end. Repeated rows are
    scored, and counted, as often as they are there. Without training rows nothing is known: the base gives the one
    unknown outcome probability 1 and the model is uniform over its groups. No rows give no rows.
    """
    chunks = encoded(docs, held_out, text)
    total, n_words = chunks.agg(F.sum("n_train"), F.sum("n_words")).first()
    total, n_words = int(total or 0), int(n_words or 0)
    chunks, distinct, by_form = counted(chunks, n_words, total)
    groups = form_groups(followers(chunks))
    model = fit(chunks, total, distinct, by_form, groups)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                often, forms, counts = words_in(row)
                kind = model.classes(forms, counts)
                inside = np.where(kind > UNKNOWN, np.log(np.maximum(counts, 1) / np.maximum(model.class_sums[kind], 1)), 0.0)
                base = np.log10((counts + 0.5) / (model.total + 0.5 * (model.distinct + 1)))
                known = (counts > 0).astype(np.int64)
                ids = pd.array(np.frombuffer(row.doc_ids, np.int64), dtype="Int64")
                ids[np.frombuffer(row.no_id, np.uint8) == 1] = pd.NA
                held = np.frombuffer(row.held, np.uint8) == 1
                for docs, tokens, sizes in blocks_of(row):
                    features = model.features(often, forms, counts, tokens, sizes)
                    log_p = model.class_log(features, kind[tokens]) + inside[tokens]
                    starts = np.cumsum(sizes) - sizes
                    yield pd.DataFrame(
                        {
                            "doc_id": ids[docs],
                            "held_out": held[docs],
                            "n_tokens": sizes.astype(np.int64),
                            "n_known": np.add.reduceat(known[tokens], starts),
                            "train_tokens": np.full(len(sizes), model.total),
                            "base_score": np.add.reduceat(base[tokens], starts),
                            "score": np.add.reduceat(log_p, starts) / np.log(10),
                        }
                    )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return chunks.drop("chunk", "n_train").mapInPandas(scored, schema)
