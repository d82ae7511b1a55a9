"""Licence scans by digests of canonical texts.

A text is made canonical: lower case, without copyright lines, spelled one way, punctuation and space as single spaces.
Its SHA-256 is joined to the digests of known licence texts, so entire texts are compared and nothing else. A document
is looked up as a whole, and each of its lines by itself, since notices are often a line of a text.

Canonical texts lose whole lines that begin with the word copyright, so they depend on where a text is wrapped. Rows of words
do not: where the first words of a known text stand, as many words as it has are hashed and looked up, once with all
words and once without those of copyright statements. So a known text is found in any wrapping, alone in a document or in a run of its
lines, and by its digest every time.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache, reduce
from pathlib import Path

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.functions.once import once

#: Spellings that count as one (the SPDX guidelines' equivalent words that occur in short licences).
EQUIVALENT = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("sub licensed", "sublicensed"),
    ("non commercial", "noncommercial"),
    ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("fulfil", "fulfill"),
    ("organisation", "organization"),
    ("http", "https"),
)
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright\b|\(c\)|©|all rights reserved).*$"
#: Known texts, whole licences and one-line notices.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    (
        "MIT",
        """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
    (
        "BSD-2-Clause",
        """Copyright (c) <year> <owner>

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
)


def canonical(text: Column) -> Column:
    """The canonical form in DataFrame functions."""
    plain = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for one, other in EQUIVALENT:
        plain = F.replace(plain, F.lit(f" {one} "), F.lit(f" {other} "))
    return F.trim(plain)


def canonical_text(text: str) -> str:
    """The same for the known texts."""
    plain = re.sub(r"(?m)^[\W_\n]*?(?:copyright\b|\(c\)|©|all rights reserved).*$", " ", text.lower())
    plain = " " + re.sub(r"[\W_]+", " ", plain).strip() + " "
    return reduce(lambda t, pair: t.replace(f" {pair[0]} ", f" {pair[1]} "), EQUIVALENT, plain).strip()


@lru_cache(maxsize=1)
def full_texts() -> tuple[tuple[str, str], ...]:
    """The licences of the data folder: entire texts, and those up to the end of the terms without what follows."""
    found = []
    for file in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
        text, name = file.read_text(encoding="utf-8"), file.name[: -len(".txt")]
        title, everyone, rest = text.partition("Everyone is permitted to copy")
        if everyone:
            # The publisher's address between the title and this sentence has changed over time.
            text = "\n".join(title.strip().split("\n\n")[:1]) + "\n\n" + everyone + rest
        found.append((name, text))
        terms, end, rest = text.partition("END OF TERMS AND CONDITIONS")
        if rest.strip():
            found += [(name, terms + end), (name, terms)]
    for name, text in (*KNOWN, *found):
        if name.startswith("BSD-") and "\n" in text:
            found.append((name, re.sub(r"(?m)^\s*[1-4]\. ", "* ", text)))
    return tuple(found)


def known_digests(texts: tuple[tuple[str, str], ...] = KNOWN) -> list[tuple[str, str, int]]:
    """(licence, digest, length of the canonical text), each digest once."""
    found = {}
    for name, text in texts:
        plain = canonical_text(text)
        found.setdefault(hashlib.sha256(plain.encode()).hexdigest(), (name, len(plain)))
    return [(name, digest, n) for digest, (name, n) in found.items()]


WORD = re.compile(r"[^\W_]+")
#: A real copyright statement: the word or sign, and the sign, a year or a placeholder.
STATEMENT = re.compile(r"[\W_]*(?:portions\s+)?(?:copyright[\W_]*(?:\(c\)|©|\d{4}|[<\[{]|year\b|yyyy\b)|(?:\(c\)|©)\s*\d{4}|all rights reserved)", re.I)
_SINGLE = {a: b for a, b in EQUIVALENT if " " not in a}
_SINGLE |= {f"sub{a}": f"sub{b}" for a, b in EQUIVALENT if a.startswith("licence")} | {"holder": "owner", "holders": "owners"}
#: The rules below hold for lower-cased text, in expressions that mean the same to Java, to SQL and to Python's regex.
_EDGE, _NO_WORD = r"(^|[^\p{L}\p{N}])", r"[^\p{L}\p{N}]+"
#: Words written in two parts, on one line and over a line end; the line end moves behind them.
_PARTED = (_EDGE + r"(non|sub)[ \t-]+(commercial|licen[cs])", _EDGE + r"(non|sub)[ \t-]*\n[^\p{L}\p{N}\n]*(commercial|licen[cs]\p{L}*)")
#: Full stops that end no sentence, after one letter and after these abbreviations.
_ABBREVIATED = r"(^|[^\p{L}\p{N}.])(inc|ltd|co|corp|llc|jr|sr|dr|st|[a-z])\."
_BEGINS = (
    r"(?:portions[ \t]+)?copyright[^\p{L}\p{N}\n]*(?:\(c\)|©|[0-9]{4}|[<\[{]|(?:year|yyyy)(?:[^\p{L}\p{N}]|$))"
    r"|(?:\(c\)|©)[ \t]*[0-9]{4}|all rights reserved"
)
#: A statement goes from there to the end of its sentence, of its line or to where a known text begins.
_STATED = r"^[^\p{L}\p{N}]*(?:" + _BEGINS + r")[^.!?;:]*(?:[.!?;:]+[^ \t\r.!?;:][^.!?;:]*)*"
#: Words that no mere statement of who has the copyright needs.
_NEVER = (
    _EDGE + r"(?:may|must|shall|not|no|without|permission|permitted|prohibited|forbidden|granted|consent|use|used|using)"
    r"(?:[^\p{L}\p{N}]|$)"
)
MARK = "\x1e"
ANCHOR = 3


@dataclass(frozen=True)
class Word:
    line: int
    word: str
    stated: bool


def parted(text: str) -> tuple[str, str]:
    """(title, body): a title is a first paragraph without a full stop; copyright statements between them are dropped."""
    first, _, rest = text.strip().partition("\n\n")
    title = first if rest and not STATEMENT.match(first) and not re.search(r"[.:;]\s*$", first) else ""
    return title, rest if title or STATEMENT.match(first) else text


def plain_words(text: str) -> list[str]:
    return [_SINGLE.get(w, w) for w in regex.split(_NO_WORD, text) if w]


def unparted(text: str) -> str:
    text = regex.sub(_PARTED[0], r"\1\2\3", text.lower())
    text = regex.sub(_PARTED[1], r"\1\2\3\n", text)
    return regex.sub(_ABBREVIATED, r"\1\2 ", regex.sub(_ABBREVIATED, r"\1\2 ", text))


def marked_words(text: str, marks: str) -> list[Word]:
    """All words with their line (from 0), and whether they belong to a copyright statement."""
    found = []
    for n, line in enumerate(regex.sub(marks, r"\1" + MARK + r"\2", unparted(text)).split("\n")):
        for piece in line.split(MARK):
            said = regex.search(_STATED, piece)
            end = said.end() if said and not regex.search(_NEVER, said[0]) else 0
            found += [Word(n, w, True) for w in plain_words(piece[:end])] + [Word(n, w, False) for w in plain_words(piece[end:])]
    return found


@dataclass(frozen=True)
class Spans:
    """What rows of words are looked up by.

    ``known`` has licence by digest of the words of a body; ``lengths`` the numbers of words of the bodies with these first
    words; ``titles`` what may stand before one; ``opening`` what every text with one of them matches; ``marks`` where
    a copyright statement ends or begins.
    """

    known: dict[str, str]
    lengths: dict[str, list[int]]
    titles: list[str]
    opening: str
    marks: str


def body_of(text: str) -> str:
    body = parted(text)[1]
    while STATEMENT.match(body) and "\n\n" in body:
        body = body.partition("\n\n")[2]
    return body


@lru_cache(maxsize=4)
def spans_of(texts: tuple[tuple[str, str], ...]) -> Spans:
    bodies = [(name, body_of(text)) for name, text in texts]
    firsts = {tuple(plain_words(unparted(body))[:ANCHOR]) for _, body in bodies}
    spelled = lambda w: "(?:" + "|".join([w, *(a for a, b in _SINGLE.items() if b == w)]) + ")"
    opening = _EDGE + "(" + "|".join(sorted(_NO_WORD.join(map(spelled, f)) for f in firsts)) + ")"
    marks = opening[:-1] + "|" + _BEGINS + ")"
    known, lengths = {}, {}
    for name, body in bodies:
        words = marked_words(body, marks)
        # With the statements inside, for texts in one line, and without, for texts in which they are filled in.
        for row in ([w.word for w in words], [w.word for w in words if not w.stated]):
            if tuple(row[:ANCHOR]) in firsts:
                known.setdefault(span_digest(row), name)
                lengths.setdefault(" ".join(row[:ANCHOR]), set()).add(len(row))
    titles = {" ".join(plain_words(unparted(parted(text)[0]))) for _, text in texts} - {""}
    titles |= {f"the {t}" for t in titles}
    return Spans(known, {a: sorted(n) for a, n in sorted(lengths.items())}, sorted(titles), opening, marks)


def span_digest(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


def whole_licence(text: str | None, texts: tuple[tuple[str, str], ...]) -> str | None:
    """The known licence that a text is, in any wrapping: the rule of ``scan`` for one text, in plain Python."""
    spans, best = spans_of(texts), (0, "")
    words = marked_words(text or "", spans.marks)
    for row in (words, [w for w in words if not w.stated]):
        for p in range(len(row) - ANCHOR + 1):
            n = len(row) - p
            if n > best[0] and n in spans.lengths.get(" ".join(w.word for w in row[p : p + ANCHOR]), ()):
                before = " ".join(w.word for w in row[:p] if not w.stated)
                digest = span_digest([w.word for w in row[p:]])
                if before in ("", *spans.titles) and digest in spans.known:
                    best = (n, spans.known[digest])
    return best[1] or None


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def _table(pairs: dict) -> Column:
    """A literal map."""
    kind = "string" if all(isinstance(v, str) for v in pairs.values()) else "array<int>"
    return F.map_from_arrays(_strings(list(pairs)), F.array(*[F.lit(v) for v in pairs.values()]).cast(f"array<{kind}>"))


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_column(text: Column, spans: Spans) -> Column:
    """``marked_words`` of each text: ``array<struct<line: int, word: string, stated: boolean>>``."""
    t = F.regexp_replace(F.lower(text), _PARTED[0], "$1$2$3")
    t = F.regexp_replace(t, _PARTED[1], "$1$2$3\n")
    for _ in range(2):
        t = F.regexp_replace(t, _ABBREVIATED, "$1$2 ")
    t = F.regexp_replace(t, spans.marks, f"$1{MARK}$2")
    spelled = _table(_SINGLE)

    def words(piece: Column, line: Column, stated: bool) -> Column:
        some = F.filter(F.split(piece, _NO_WORD), lambda w: w != "")
        spell = lambda w: F.coalesce(F.try_element_at(spelled, w), w)
        return F.transform(some, lambda w: F.struct(line.alias("line"), spell(w).alias("word"), F.lit(stated).alias("stated")))

    def of_piece(piece: Column, line: Column) -> Column:
        def cut(said: Column) -> Column:
            end = F.when(said.rlike(_NEVER), 0).otherwise(F.length(said))
            return _let(end, lambda n: F.concat(words(F.substring(piece, F.lit(1), n), line, True), words(F.substring(piece, n + 1, F.length(piece)), line, False)))

        return _let(F.regexp_extract(piece, _STATED, 0), cut)

    lines = F.transform(F.split(t, "\n"), lambda line, n: F.flatten(F.transform(F.split(line, MARK), lambda piece: of_piece(piece, n))))
    return F.flatten(lines)


def runs_column(words: Column, spans: Spans) -> Column:
    """The rows of words that are a known body: ``array<struct<n, digest, license_id, first, last, whole, aligned>>``.

    ``n`` is the number of words, ``first`` and ``last`` are lines from 0. A run is ``whole`` if nothing else is in the text but a
    title and copyright statements before it, and ``aligned`` if that holds for its lines.
    """
    lengths, known, titles = _table(spans.lengths), _table(spans.known), _strings(["", *spans.titles])

    def of_row(row: Column) -> Column:
        size = F.size(row)
        word = lambda i: F.get(row, i).getField("word")
        line = lambda i: F.get(row, i).getField("line")
        places = F.when(size >= ANCHOR, F.sequence(F.lit(0), size - ANCHOR)).otherwise(F.array().cast("array<int>"))
        begun = F.transform(
            places,
            lambda p: F.struct(p.alias("p"), F.try_element_at(lengths, F.concat_ws(" ", *[word(p + k) for k in range(ANCHOR)])).alias("ns")),
        )
        begun = F.filter(begun, lambda b: b["ns"].isNotNull())

        def free(before: Column) -> Column:
            said = F.transform(F.filter(before, lambda w: ~w.getField("stated")), lambda w: w.getField("word"))
            return F.array_contains(titles, F.array_join(said, " "))

        def run(p: Column, n: Column) -> Column:
            text = F.array_join(F.transform(F.slice(row, p + 1, n), lambda w: w.getField("word")), " ")
            before = F.slice(row, F.lit(1), p)
            ends = p + n == size
            own = F.filter(before, lambda w: w.getField("line") == line(p))
            return _let(
                F.sha2(text.cast("binary"), 256),
                lambda digest: F.struct(
                    n.alias("n"),
                    digest.alias("digest"),
                    F.try_element_at(known, digest).alias("license_id"),
                    line(p).alias("first"),
                    line(p + n - 1).alias("last"),
                    F.when(ends, free(before)).otherwise(F.lit(False)).alias("whole"),
                    ((ends | (line(p + n) != line(p + n - 1))) & free(own)).alias("aligned"),
                ),
            )

        found = F.flatten(
            F.transform(begun, lambda b: F.transform(F.filter(b["ns"], lambda n: b["p"] + n <= size), lambda n: run(b["p"], n)))
        )
        return F.filter(found, lambda r: r["license_id"].isNotNull())

    bare = F.filter(words, lambda w: ~w.getField("stated"))
    return F.array_distinct(F.concat(of_row(words), _let(bare, of_row)))


def scan(
    docs: DataFrame,
    texts: tuple[tuple[str, str], ...] = KNOWN,
    text: str = "text",
    more: tuple[tuple[str, str], ...] | None = None,
) -> DataFrame:
    """``doc_id, line, digest, license_id``: a row for each document as a whole (``line`` null, ``license_id`` null if
    it is no known licence), one for each of its lines that is a known text, and one for each run of lines that is one
    (``line`` from 1).

    ``license_id`` of a whole document is that of the known text with the digest of its canonical form, or else of the
    known body whose digest its words have after a title and copyright statements; ``digest`` is that of the canonical form.
    A run has the line where the body begins and the digest of its words. Runs begin and end with their lines, but for a title and
    statements in front; one within a longer one is left out, and so are those of a document that is a licence as a whole.
    A statement ends with its sentence, its line or where a known text begins, whatever its length; a sentence that says
    what one may or must not do is none. ``more`` are texts known by their bodies only. The same as ``scan_sql``.

    The known texts are the caller's list, so their digests are broadcast. Rows of words are only made of documents with the
    first words of a known text, and hashed where as many words follow. A null text has a null digest and no lines; a text without letters or
    digits has the digest of the empty text. Repeated rows are reported each. Nothing is shuffled, no Python runs.
    """
    spark = docs.sparkSession
    more = full_texts() if more is None else more
    known, spans = known_digests(texts), spans_of((*texts, *more))
    listed = F.broadcast(spark.createDataFrame([(d, n) for n, d, _ in known], "_known string, license_id string"))
    lengths = sorted({n for _, _, n in known})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("_text"))
    # The same as ``spans.opening``, without taking up the character before.
    some = F.lower("_text").rlike(spans.opening.replace(_EDGE, r"(?<![\p{L}\p{N}])", 1))
    # One-element arrays keep words and runs from being made again by every expression that names them.
    runs = once(F.when(some, _let(words_column(F.col("_text"), spans), lambda w: runs_column(w, spans))))
    whole = rows.withColumn("digest", F.sha2(canonical(F.col("_text")).cast("binary"), 256)).withColumn("_runs", runs)
    best = F.array_max(
        F.transform(F.filter("_runs", lambda r: r["whole"]), lambda r: F.struct(r["n"], r["digest"], r["license_id"].alias("license_id")))
    )
    digests = _strings(sorted(d for _, d, _ in known))
    line_digest = lambda n: F.sha2(canonical(F.get(F.split("_text", "\n"), n)).cast("binary"), 256)
    longer = lambda r, s: (s["first"] <= r["first"]) & (s["last"] >= r["last"]) & ((s["n"] > r["n"]) | ((s["n"] == r["n"]) & (s["digest"] < r["digest"])))

    def reported(all_runs: Column) -> Column:
        aligned = F.filter(all_runs, lambda r: r["aligned"])
        outer = _let(aligned, lambda a: F.filter(a, lambda r: ~F.exists(a, lambda s: longer(r, s))))
        return F.filter(outer, lambda r: (r["first"] != r["last"]) | ~F.array_contains(digests, line_digest(r["first"])))

    # The row of the whole and those of its runs come from one pass over the text.
    named = whole.join(listed, F.col("digest") == F.col("_known"), "left")
    no_line, is_whole = F.lit(None).cast("int"), F.exists("_runs", lambda r: r["whole"])
    own = F.struct(no_line.alias("line"), F.col("digest"), F.coalesce("license_id", best.getField("license_id")).alias("license_id"))
    row = lambda r: F.struct((r["first"] + 1).cast("int").alias("line"), r["digest"].alias("digest"), r["license_id"].alias("license_id"))
    runs_of = F.when(F.size("_runs") > 0, F.when(~is_whole, F.transform(reported(F.col("_runs")), row)))
    every = F.concat(F.array(own), F.coalesce(runs_of, F.slice(F.array(own), 1, 0)))
    out = named.select("doc_id", F.explode(every).alias("r")).select("doc_id", "r.line", "r.digest", "r.license_id")

    lines = rows.filter(F.length("_text") >= min(lengths)).select("doc_id", F.posexplode(F.split("_text", "\n")).alias("line", "_line"))
    lines = lines.filter(F.length("_line") >= min(lengths)).select(
        "doc_id", (F.col("line") + 1).alias("line"), F.explode(F.array(canonical(F.col("_line")))).alias("_plain")
    )
    lines = lines.filter(F.length("_plain").isin(lengths)).select(
        "doc_id", "line", F.sha2(F.col("_plain").cast("binary"), 256).alias("digest")
    )
    return out.unionByName(lines.join(listed, F.col("digest") == F.col("_known")).drop("_known"))


def scan_sql() -> str:
    """The same over ``documents`` in SQL."""
    spans = spans_of((*KNOWN, *full_texts()))
    text_of = lambda s: "'" + s.replace("'", "''") + "'"

    def plain(column: str) -> str:
        made = f"regexp_replace(lower({column}), '{COPYRIGHT_LINE}', ' ', 'g')"
        made = f"' ' || trim(regexp_replace({made}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
        for one, other in EQUIVALENT:
            made = f"replace({made}, ' {one} ', ' {other} ')"
        return f"trim({made})"

    def replaced(t: str, pattern: str, by: str) -> str:
        return f"regexp_replace({t}, {text_of(pattern)}, {by}, 'g')"

    t = replaced("lower(text)", _PARTED[0], r"'\1\2\3'")
    t = replaced(t, _PARTED[1], r"'\1\2\3' || chr(10)")
    for _ in range(2):
        t = replaced(t, _ABBREVIATED, r"'\1\2 '")
    t = replaced(t, spans.marks, r"'\1' || chr(30) || '\2'")
    spelled = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _SINGLE.items())
    known = ", ".join(f"('{digest}', '{name}')" for name, digest, _ in known_digests())
    bodies = ", ".join(f"('{digest}', '{name}')" for digest, name in spans.known.items())
    begins = ", ".join(f"({text_of(a)}, {n})" for a, ns in spans.lengths.items() for n in ns)
    titles = ", ".join(map(text_of, ["", *spans.titles]))
    return f"""
WITH known(digest, license_id) AS (VALUES {known}),
body(digest, license_id) AS (VALUES {bodies}),
begins(a3, n) AS (VALUES {begins}),
docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
whole AS (SELECT rid, doc_id, sha256({plain('text')}) AS digest FROM docs),
split AS (SELECT rid, doc_id, string_split(text, chr(10)) AS parts FROM docs),
numbered AS (SELECT rid, doc_id, parts, unnest(range(1, len(parts) + 1)) AS n FROM split),
lines AS MATERIALIZED (SELECT rid, doc_id, CAST(n AS INTEGER) AS line, l.digest, license_id
    FROM (SELECT rid, doc_id, n, sha256({plain('parts[n]')}) AS digest FROM numbered) l JOIN known USING (digest)),
-- Rows of words, of texts with the first words of a known one.
texts AS (SELECT rid, string_split({t}, chr(10)) AS ls FROM docs WHERE regexp_matches(lower(text), {text_of(spans.opening)})),
rows_of AS (SELECT rid, unnest(range(0, len(ls))) AS line, unnest(ls) AS l FROM texts),
cut AS (SELECT rid, line, unnest(range(0, len(ps))) AS k, unnest(ps) AS piece FROM (SELECT rid, line, string_split(l, chr(30)) AS ps FROM rows_of)),
said AS (SELECT *, regexp_extract(piece, {text_of(_STATED)}, 0) AS st FROM cut),
ended AS (SELECT *, CASE WHEN regexp_matches(st, {text_of(_NEVER)}) THEN 0 ELSE length(st) END AS n FROM said),
halves AS (SELECT rid, line, k, 0 AS h, substr(piece, 1, n) AS part FROM ended
    UNION ALL SELECT rid, line, k, 1, substr(piece, n + 1) FROM ended),
tokens AS (SELECT rid, line, k, h, unnest(range(0, len(ws))) AS j, unnest(ws) AS w FROM (
    SELECT rid, line, k, h, list_filter(string_split_regex(part, '{_NO_WORD}'), lambda x: x <> '') AS ws FROM halves)),
spelled AS (SELECT rid, line, h = 0 AS stated, CASE w {spelled} ELSE w END AS w, k, h, j FROM tokens),
word AS MATERIALIZED (
    SELECT rid, 'a' AS v, line, stated, w, row_number() OVER (PARTITION BY rid ORDER BY line, k, h, j) - 1 AS i FROM spelled
    UNION ALL SELECT rid, 'b', line, stated, w, row_number() OVER (PARTITION BY rid ORDER BY line, k, h, j) - 1 FROM spelled WHERE NOT stated),
three AS (SELECT *, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS a3, count(*) OVER (PARTITION BY rid, v) AS size
    FROM word WINDOW o AS (PARTITION BY rid, v ORDER BY i)),
begun AS (SELECT t.rid, t.v, t.i AS p, b.n, t.line AS first, t.size FROM three t JOIN begins b USING (a3) WHERE t.i + b.n <= t.size),
hashed AS (SELECT g.rid, g.v, p, n, first, size, max(line) AS last, sha256(string_agg(w, ' ' ORDER BY i)) AS digest
    FROM begun g JOIN word USING (rid, v) WHERE i >= p AND i < p + n GROUP BY g.rid, g.v, p, n, first, size),
found AS MATERIALIZED (SELECT h.*, b.license_id FROM hashed h JOIN body b USING (digest)),
before AS (SELECT f.rid, f.v, f.p, coalesce(string_agg(w.w, ' ' ORDER BY w.i) FILTER (NOT w.stated), '') AS whole_before,
      coalesce(string_agg(w.w, ' ' ORDER BY w.i) FILTER (NOT w.stated AND w.line = f.first), '') AS own_before
    FROM (SELECT DISTINCT rid, v, p, first FROM found) f LEFT JOIN word w ON w.rid = f.rid AND w.v = f.v AND w.i < f.p GROUP BY f.rid, f.v, f.p),
runs AS MATERIALIZED (SELECT DISTINCT f.rid, f.n, f.digest, f.license_id, f.first, f.last,
      f.p + f.n = f.size AND whole_before IN ({titles}) AS is_whole,
      (f.p + f.n = f.size OR nx.line <> f.last) AND own_before IN ({titles}) AS aligned
    FROM found f JOIN before USING (rid, v, p) LEFT JOIN word nx ON nx.rid = f.rid AND nx.v = f.v AND nx.i = f.p + f.n),
licence AS (SELECT rid, arg_max(license_id, (n, digest)) AS license_id FROM runs WHERE is_whole GROUP BY rid)
SELECT w.doc_id, CAST(NULL AS INTEGER) AS line, w.digest, coalesce(k.license_id, c.license_id) AS license_id
FROM whole w LEFT JOIN known k USING (digest) LEFT JOIN licence c USING (rid)
UNION ALL SELECT doc_id, line, digest, license_id FROM lines
UNION ALL SELECT d.doc_id, CAST(r.first + 1 AS INTEGER), r.digest, r.license_id FROM runs r JOIN docs d USING (rid)
WHERE r.aligned AND r.rid NOT IN (SELECT rid FROM runs WHERE is_whole)
  AND NOT EXISTS (SELECT 1 FROM runs s WHERE s.rid = r.rid AND s.aligned AND s.first <= r.first AND s.last >= r.last
                  AND (s.n > r.n OR (s.n = r.n AND s.digest < r.digest)))
  AND NOT (r.first = r.last AND EXISTS (SELECT 1 FROM lines l WHERE l.rid = r.rid AND l.line = r.first + 1))
"""
