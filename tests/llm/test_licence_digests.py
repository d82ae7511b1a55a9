"""Licence scans beside their SQL, on documents with whole licences in every manner."""

import textwrap
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from framelark.llm import licences
from .test_licence_texts import FULL, copies_of

TEXTS = dict((n, t) for n, t in FULL)
MIT, BSD = TEXTS["MIT"], TEXTS["BSD-2-Clause"]
WHOLE = dict((n, t) for n, t in licences.full_texts())


def body(text):
    return licences.body_of(text)


def holders(n):
    return "\n".join(f"Copyright (c) {1900 + i} Holder Number {i}, Inc. All rights reserved." for i in range(n))


CASES = {
    "flat": (" ".join(body(MIT).split()), "MIT"),
    "wrapped": ("\n".join(textwrap.wrap(" ".join(body(MIT).split()), 37)), "MIT"),
    "two hundred holders": (f"MIT License\n\n{holders(200)}\n\n{body(MIT)}", "MIT"),
    "one long statement": ("Copyright (c) 2020 " + " and ".join(f"Person {i}" for i in range(300)) + "\n" + body(MIT), "MIT"),
    "abbreviations": (f"Copyright (c) 2020 J. R. Smith, Foo Inc. and Bar Co. Ltd.\n{body(BSD)}", "BSD-2-Clause"),
    "two sentences": (f"Copyright 2020 Foo. All rights reserved.\n\n{body(BSD)}", "BSD-2-Clause"),
    "flat with statement": ("The MIT License Copyright 2020 Some One " + " ".join(body(MIT).split()), "MIT"),
    "apache filled in": (WHOLE["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2021 Some One"), "Apache-2.0"),
    "gpl": (WHOLE["GPL-3.0"], "GPL-3.0"),
    "spelled otherwise": (body(MIT).replace("sublicense", "sub-licence").replace("copies", "COPIES"), "MIT"),
    "one notice": ("Released under the MIT License.", "MIT"),
    "prohibition": ("Copyright 2020 me. No one may use this file without my written consent, whatever is said below.\n" + body(MIT), None),
    "prohibition in one": ("Copyright 2020 Foo Inc. No one may use this file without my written consent\n" + body(MIT), None),
    "prohibition, one line": ("Copyright 2020 me, and you must not use it " + " ".join(body(MIT).split()), None),
    "prose before": ("Some prose.\n" + body(MIT), None),
    "prose behind": (body(MIT) + "\nMore prose.", None),
    "cut": (body(MIT)[:-30], None),
    "changed": (body(MIT).replace("WITHOUT WARRANTY", "WITH WARRANTY"), None),
    "null": (None, None),
    "empty": ("", None),
}
#: Runs inside documents: line and licence.
RUNS = {
    "prohibition": [(2, "MIT")],
    "prohibition in one": [(2, "MIT")],
    "prose before": [(2, "MIT")],
    "prose behind": [(1, "MIT")],
    "commented": [(3, "MIT")],
    "two of them": [(2, "MIT"), (2 + len(body(MIT).split("\n")) + 1, "BSD-2-Clause")],
    "notice over two lines": [(2, "MIT")],
    "notice": [(2, "MIT")],
}
INSIDE = {
    "commented": "/*\n * Copyright 2020 Some One\n" + "\n".join(f" * {line}" for line in body(MIT).split("\n")) + "\n */\nint main;",
    "two of them": f"Prose.\n{body(MIT)}\nMore.\n{body(BSD)}\nEnd.",
    "notice over two lines": "Prose.\nReleased under\nthe MIT License.\nMore prose.",
    "notice": "Prose.\nReleased under the MIT License.\nMore.",
    "not on its own": "Prose released under\nthe MIT License.\nMore.",
    "in a line": "All of it: Released under the MIT License. And more.",
}
DOCS = [(name, text) for name, (text, _) in CASES.items()] + list(INSIDE.items())


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(DOCS)], "doc_id long, text string")
    found = licences.scan(docs)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    return found.collect()


def test_whole_documents(rows):
    found = {DOCS[r.doc_id][0]: r.license_id for r in rows if r.line is None}
    assert {n: found[n] for n in CASES} == {n: name for n, (_, name) in CASES.items()}
    assert {n: licences.whole_licence(t, (*licences.KNOWN, *licences.full_texts())) for n, (t, _) in CASES.items()} == {n: found[n] for n in CASES}


def test_runs_of_lines(rows):
    found = {}
    for r in rows:
        if r.line is not None:
            found.setdefault(DOCS[r.doc_id][0], []).append((r.line, r.license_id))
    named = {n: sorted(v) for n, v in found.items() if n != "one notice"}
    assert named == {n: sorted(v) for n, v in RUNS.items()}


def difference_from_sql(spark, texts):
    table = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    con = duckdb.connect()
    con.register("documents", table)
    expected = Counter(con.execute(licences.scan_sql()).fetchall())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = Counter(tuple(r) for r in licences.scan(docs).collect())
    return found - expected, expected - found


def test_scan_equals_its_sql(spark):
    texts = [t for _, t in DOCS] + [t for _, text in FULL for t in copies_of(text)]
    texts += ["Portions Copyright (C) 2020 x; (c) 2001 y. © 1999 z\n\n\x1e odd \x1e" + MIT, "²Ⅷ ½ É\r\nLICENCE\tnon-\ncommercial sub licence", MIT, MIT]
    assert difference_from_sql(spark, texts) == (Counter(), Counter())


def test_full_texts_equal_the_sql(spark):
    texts = [t for _, t in licences.full_texts()] + ["Prose.\n" + t + "\nprose" for _, t in licences.full_texts()][:8]
    assert difference_from_sql(spark, texts) == (Counter(), Counter())


def test_no_documents(spark):
    assert licences.scan(spark.createDataFrame([], "doc_id long, text string, digest int, line string")).collect() == []
