"""Known licences in other wrappings than the stored ones."""

import re
import textwrap

import pytest
from framelark.llm import licences

FULL = [(n, t) for n, t in licences.KNOWN if "\n\n" in t]


def copies_of(text):
    title, body = licences.parted(text)
    while licences.STATEMENT.match(body):
        body = body.partition("\n\n")[2]
    narrow = ["\n\n".join(textwrap.fill(p, n, break_long_words=False) for p in re.split(r"\n\s*\n", body)) for n in (40, 66, 78)]
    paragraphs = "\n".join(" ".join(p.split()) for p in re.split(r"\n\s*\n", body))
    flat = " ".join(body.split())
    bare = [*narrow, paragraphs, flat]
    stated = [f"Copyright (c) 2020 Some One\n\n{b}" for b in bare] + [f"Copyright (c) 2020 Some One {flat}"]
    return bare + stated + [f"{title}\n\n{b}" for b in stated] + [" ".join(f"{title} Copyright 2020, X {flat}".split())]


@pytest.mark.parametrize("name,text", FULL, ids=[n for n, _ in FULL])
def test_every_wrapping_is_the_same_licence(name, text):
    found = [licences.whole_licence(c, licences.KNOWN) for c in [text, *copies_of(text)]]
    assert found == [name] * len(found)


def test_cut_or_longer_texts_are_not_the_licence():
    text = dict((n, t) for n, t in FULL)["MIT"]
    flat = " ".join(text.split())
    assert licences.whole_licence(flat[:-20], licences.KNOWN) is None
    assert licences.whole_licence(flat + " Or not.", licences.KNOWN) is None
    assert licences.whole_licence("Some prose. " + flat, licences.KNOWN) is None
    assert licences.whole_licence(flat.replace("COPYRIGHT HOLDERS BE LIABLE", ""), licences.KNOWN) is None


def test_scan_finds_wrapped_texts(spark):
    text = copies_of(dict((n, t) for n, t in FULL)["MIT"])
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(text)] + [(99, "Permission is hereby granted."), (100, None)], "doc_id long, text string")
    found = {r.doc_id: r.license_id for r in licences.scan(docs).filter("line is null").collect()}
    assert found == {**{i: "MIT" for i in range(len(text))}, 99: None, 100: None}


@pytest.mark.parametrize("name,text", licences.full_texts(), ids=[f"{n}-{len(t)}" for n, t in licences.full_texts()])
def test_full_texts_in_every_wrapping(name, text):
    texts = (*licences.KNOWN, *licences.full_texts())
    found = [licences.whole_licence(c, texts) for c in [text, *copies_of(text)]]
    assert found == [name] * len(found)


def test_runs_of_lines(spark):
    mit = copies_of(dict((n, t) for n, t in FULL)["MIT"])[1]
    apache = next(t for n, t in licences.full_texts() if n == "Apache-2.0")
    commented = "\n".join(f" * {line}" for line in mit.split("\n"))
    filled = apache.replace("[yyyy] [name of copyright owner]", "2021 Some One")
    rows = [
        (1, f"/*\n * Copyright 2020 Some One\n{commented}\n */\nint main;"),
        (2, "Prose.\nReleased under\nthe MIT License.\nMore prose."),
        (3, filled),
        (4, f"Prose.\n{apache.strip()}\nMore prose."),
        (5, "Prose.\nReleased under the MIT License.\nMore."),
        (6, "Prose released under\nthe MIT License.\nMore."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.line, r.license_id) for r in licences.scan(docs).collect() if r.license_id}
    assert found == {(1, 3, "MIT"), (2, 2, "MIT"), (3, None, "Apache-2.0"), (4, 6, "Apache-2.0"), (5, 2, "MIT")}
