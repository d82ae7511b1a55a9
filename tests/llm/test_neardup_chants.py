"""Pairs whose sets of shingles are alike while their counts are not."""

import random

import numpy as np
from framelark.llm import neardup


def chanted(rng, n, times=150):
    words = [f"w{rng.randrange(10**6)}" for _ in range(n + 4)]
    return " ".join(words), " ".join([*words, *(["la", "lo"] * times)])


def test_pairs_alike_as_sets_share_a_band():
    rng = random.Random(1)
    for _ in range(30):
        a, b = (neardup.shingles(neardup.words_lower(t)) for t in chanted(rng, 300))
        plain, weighted = neardup.probability_jaccard(*a, *b)
        assert plain > 0.97 and weighted < 0.6
        assert np.intersect1d(neardup.all_band_keys(*a), neardup.all_band_keys(*b)).size


def test_links_do_not_depend_on_the_size_of_the_component():
    rng = random.Random(2)
    texts = [t for _ in range(20) for t in chanted(rng, 300)]
    bags = [neardup.shingles(neardup.words_lower(t)) for t in texts]
    for n in (2, 8, 40):
        every = np.arange(n)
        found = {tuple(sorted(p)) for p in neardup.linked(bags[:n], every, every, neardup.THRESHOLD)}
        assert found == {(i, i + 1) for i in range(0, n, 2)}


def test_classes_of_chants(spark):
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate(t for _ in range(12) for t in chanted(rng, 300))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in neardup.classes(docs).collect()} == {i: i - i % 2 for i, _ in rows}
