"""Random inputs against the standard library."""

import json
import random

from framelark import functions as fn
from framelark.plans import results

PIECES = ['"', "'", "{", "}", "[", "]", ",", ":", " ", "\t", "\\", "\\u00e9", "null", "true", "NaN", "1", "01", "-2.5e3", "x", "é", "한", "error", "id"]


def random_lines(n, seed):
    """JSON records, many of them damaged by cutting, joining and inserting."""
    rng = random.Random(seed)
    lines = []
    for i in range(n):
        record = {"id": rng.choice([i, str(i), f"한{i}", 1.5, None]), "output": rng.choice(["a b", 'q"uote', "한국어", "", {"k": [1, None]}, []])}
        if rng.random() < 0.3:
            record["error"] = rng.choice(["bad", None, {}])
        if rng.random() < 0.1:
            del record["id"]
        line = json.dumps(record, ensure_ascii=rng.random() < 0.5)
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(len(line) + 1)
            kind = rng.randrange(4)
            if kind == 0:
                line = line[:at]
            elif kind == 1:
                line = line[:at] + rng.choice(PIECES) + line[at:]
            elif kind == 2:
                line = line[:at] + line[at + 1 :]
            else:
                line = rng.choice([line + line, line + " ", "[" + line + "]", "  " + line, line + ",", line + "]"])
        lines.append(line)
    return lines


def test_lines_are_kept_and_tagged_as_python_reads_them(spark):
    lines = random_lines(4000, seed=7)
    df = spark.createDataFrame(list(enumerate(lines)), "n int, raw string")
    found = {r.n: (r.id, r.is_error) for r in results.classified(df).collect()}
    kept = 0
    for n, line in enumerate(lines):
        try:
            record = json.loads(line)
        except json.JSONDecodeError:
            record = None
        if not isinstance(record, dict):
            assert n not in found, line
            continue
        kept += 1
        assert n in found, line
        assert found[n][1] == ("error" in record), line
        wanted = record.get("id")
        if isinstance(wanted, (str, int)) and not isinstance(wanted, bool):
            assert found[n][0] == str(wanted), line
    assert 1000 < kept < 3500


def test_strip_and_words(spark):
    rng = random.Random(3)
    alphabet = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　​ab한"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(8))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", fn.strip("t").alias("s"), fn.words("t").alias("w")).collect():
        assert row.s == row.t.strip(), repr(row.t)
        assert row.w == row.t.split(), repr(row.t)


def test_ngrams_and_repeats(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    grams = {n: fn.ngrams(fn.words("t"), n) for n in (1, 2, 3)}
    columns = [g.alias(f"g{n}") for n, g in grams.items()] + [fn.repeated_count(g).alias(f"r{n}") for n, g in grams.items()]
    for row in df.select("t", *columns).collect():
        w = row.t.split()
        for n in grams:
            wanted = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]
            assert row[f"g{n}"] == wanted and row[f"r{n}"] == len(wanted) - len(set(wanted))
