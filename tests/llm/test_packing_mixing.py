"""Packing and mixing against plain versions."""

import random
import zlib

import pytest
from framelark.llm.mixing import copies, mix, source_targets
from framelark.llm.packing import fullest, pack, plan_bins
from framelark.llm.queries import PIECE_ORDER
from framelark.llm.tokens import encoder, pieces_of, token_pieces

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, length string, copies string"


def docs_of(spark, rows):
    """Documents with extra columns named like those of the operators."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "s", "l", "c") for i, t, s in rows], DOCS)


@pytest.mark.parametrize("seed", range(6))
def test_fullest_is_the_best_subset(seed):
    rng = random.Random(seed)
    lengths = {n: rng.randint(1, 2) for n in rng.sample(range(1, 40), 6)}
    room = rng.randint(5, 70)
    sums = {0}
    for n, c in lengths.items():
        sums = {s + k * n for s in sums for k in range(c + 1)}
    found = fullest(lengths, room)
    assert all(k <= lengths[n] for n, k in found.items())
    assert sum(n * k for n, k in found.items()) == max(s for s in sums if s <= room)


@pytest.mark.parametrize("seed", range(4))
def test_plan_packs_everything_tightly(seed):
    rng = random.Random(seed)
    counts = {n: rng.randint(1, 30) for n in rng.sample(range(1, 1025), 200)}
    plan = plan_bins(counts, 1024)
    packed = {}
    for inside, bins in plan:
        assert sum(n * k for n, k in inside.items()) <= 1024
        for n, k in inside.items():
            packed[n] = packed.get(n, 0) + k * bins
    assert packed == counts
    tokens = sum(n * c for n, c in counts.items())
    more_than_half = sum(c for n, c in counts.items() if n > 512)
    assert sum(b for _, b in plan) <= max(-(-tokens // 1024), more_than_half) * 1.03 + 1


def test_pieces_cover_the_ids():
    for n in (1, 5, 1023, 1024, 1025, 2048, 5000):
        pieces = pieces_of(n, 1024)
        assert [s for s, _ in pieces] == [sum(k for _, k in pieces[:i]) for i in range(len(pieces))]
        assert sum(k for _, k in pieces) == n and all(k == 1024 for _, k in pieces[1:])


def test_fast_ids_equal_the_json_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    full, ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), encoder()
    texts = ["", "plain words", "it's  \n\t x<|endoftext|>y", "naïve ñ é 漢字 😀̀", "  　lead"]
    texts += [f"a{chr(c)} {chr(c)}b" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    assert all(ids(t) == full.encode(t, add_special_tokens=False).ids for t in texts)


def test_sequences_are_gapless_and_whole(spark):
    rows = [(i, "word " * (i * 37 % 1500), "s") for i in range(60)] + [(7, None, "s"), (None, "", "s"), (8, "x", "s"), (8, "x", "s")]
    found = pack(token_pieces(docs_of(spark, rows), keep_ids=True), PIECE_ORDER).collect()
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(p.length for p in parts[:i]) for i in range(len(parts))]
        assert sum(r.length for r in parts) <= 1024
    assert len(by_sequence) <= -(-sum(r.length for r in found) // 1024) + 1
    wanted = sorted((i or -1, len(encoder()(t or "")) + 1) for i, t, _ in rows)
    total = {}
    for r in found:
        assert len(r.ids) == r.length
        assert zlib.crc32(b"".join(n.to_bytes(4, "little") for n in r.ids)) == r.ids_crc32
    ends = [r for r in found if r.ids[-1] == 2]
    for r in ends:
        total.setdefault(r.doc_id, []).append(r.start + r.length)
    assert sorted((i if i is not None else -1, n) for i, ns in total.items() for n in ns) == sorted((i, n) for i, n in wanted) or len(ends) == len(rows)


def test_nothing_to_pack(spark):
    assert pack(token_pieces(docs_of(spark, [])), PIECE_ORDER).count() == 0


def poured(sizes, weights, share, most):
    """Targets by pouring the excess over again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, free = share * sum(sizes.values()), dict.fromkeys(sizes, 0.0), [s for s in names if sizes[s]]
    while left > 1e-9 and free:
        total, spent = sum(w[s] for s in free), 0.0
        for s in free:
            give = min(left * w[s] / total, most * sizes[s] - target[s])
            target[s] += give
            spent += give
        left -= spent
        free = [s for s in free if target[s] < most * sizes[s] - 1e-9]
    return target


@pytest.mark.parametrize("seed", range(3))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, rng.randint(1, 50), rng.randint(50, 5000)]) for s in ("a", "B", "ä", "\U0001f600", "￿", None)}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in source_targets(frame, [5, 2, 1], 1.5, 2.0).collect()}
    expected = poured(sizes, [5, 2, 1], 1.5, 2.0)
    assert all(found[s] == pytest.approx(expected[s], abs=1e-6) for s in sizes)


def mixed_rows():
    rng = random.Random(3)
    rows = [(i, "w " * rng.choice([1, 3, 40, 200]), rng.choice(["a", "a", "b", "c", None])) for i in range(400)]
    return [*rows, (400, None, "a"), (401, "  \t", "b"), (402, "x", "empty?"), (5, rows[5][1], rows[5][2]), (None, "n o", "c")]


def test_mix_hits_its_targets_and_reruns_agree(spark):
    docs = docs_of(spark, mixed_rows())
    one, two = (copies(d).collect() for d in (docs, docs.repartition(7)))
    assert sorted(map(repr, one)) == sorted(map(repr, two)) and len(one) == docs.count()
    taken, target, largest = {}, {}, {}
    for r in one:
        assert 0 <= r.copies <= 2 and r.size == len((dict_text(docs, r) or "").split())
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        target[r.source] = r.target
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(r.size for r in one))


def dict_text(docs, r, cache={}):
    if not cache:
        cache.update({d.doc_id: d.text for d in docs.collect()})
    return cache[r.doc_id]


def test_mixed_documents_keep_their_columns(spark):
    docs = docs_of(spark, mixed_rows())
    expected = sum(r.copies for r in copies(docs).collect())
    found = mix(docs)
    assert found.columns == docs.columns and found.count() == expected
    empty = docs_of(spark, [])
    assert copies(empty).count() == 0 and mix(empty).count() == 0
    silent = docs_of(spark, [(1, None, None), (2, "", "a")])
    assert [r.copies for r in copies(silent).collect()] == [0, 0]


def test_groups_meet_up_the_tree(spark, monkeypatch):
    import framelark.llm.mixing as mixing

    monkeypatch.setattr(mixing, "GROUP", 8)
    rows = mixing.copies(docs_of(spark, mixed_rows())).collect()
    for s in {r.source for r in rows}:
        mine = [r for r in rows if r.source == s]
        assert abs(sum(r.size * r.copies for r in mine) - mine[0].target) <= max(r.size for r in mine)
