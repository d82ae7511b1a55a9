"""Pseudonyms against a Feistel permutation in plain Python, in the forms that European texts have."""

import datetime
import hashlib
import re

import pytest
from framelark.llm.pseudonyms import pseudonymised

KEY = "k"
ZERO = datetime.date(1900, 1, 1)
ONE, TWO = {"1", "7"}, {str(n) for n in (20, 27, *range(30, 35), 36, 39, 40, 41, *range(43, 50), *range(51, 59), *range(60, 67), 81, 82, 84, 86, *range(90, 96), 98)}


def permuted(values, limits, kind):
    state, half = list(values), len(limits) // 2
    for turn in range(8):
        first = turn % 2 == 0
        other = ",".join(str(v) for i, v in enumerate(state) if (i < half) != first)
        ground = "|".join([KEY, kind, str(turn), other])
        for i in range(len(state)):
            if (i < half) == first:
                shift = int(hashlib.sha256(f"{ground}|{i}".encode()).hexdigest()[:12], 16)
                state[i] = (state[i] + shift) % limits[i]
    return state


def digits(text, kind):
    return "".join(map(str, permuted([int(c) for c in text], [10] * len(text), kind)))


def in_layout(layout, new):
    new = iter(new)
    return "".join(next(new) if c.isdigit() else c for c in layout)


def phone(m):
    own = re.sub(r"\D", "", m)
    code = 0 if m[0] != "+" else 1 if own[0] in ONE else 2 if own[:2] in TWO else 3
    return in_layout(m, own[:code] + digits(own[code:], "phone"))


def moved(day):
    n = (day - ZERO).days
    low, high = permuted([n % 229, n // 229], [229, 319], "date")
    return ZERO + datetime.timedelta(days=low + high * 229)


def date(m, order):
    mark = re.search(r"[./-]", m)[0]
    parts = m.split(mark)
    at = {k: int(p) for k, p in zip(order, parts)}
    day = moved(datetime.date(at["y"], at["m"], at["d"]))
    while order == "dmy" and mark == "/" and day.day <= 12:
        day = moved(day)
    wide = all(len(p) >= 2 for p in parts)
    new = {"y": f"{day.year:04d}", "m": f"{day.month:02d}" if wide else str(day.month), "d": f"{day.day:02d}" if wide else str(day.day)}
    return mark.join(new[k] for k in order)


def ip6(m):
    head, _, tail = m.partition("::") if "::" in m else (m, "", "")
    head, tail = [g for g in head.split(":") if g], [g for g in tail.split(":") if g]
    groups = [int(g, 16) for g in [*head, *["0"] * (8 - len(head) - len(tail)), *tail]]
    return ":".join(f"{n:x}" for n in permuted(groups, [65536] * 8, "ip6"))


CASES = [
    *[(m, phone) for m in (
        "+33 1 23 45 67 89", "+49 30 1234567", "+49 151 12345678", "+4915112345678", "+1 (017) 555-7713", "555 123 4567",
        "030 1234567", "01 23 45 67 89", "0151-1234567", "+44 20 7946 0958", "+353 1 234 5678", "+7 495 123-45-67", "251-555-0199",
    )],
    *[(m, lambda m: date(m, "dmy")) for m in ("31/12/2001", "1.2.2001", "31.12.2001", "31-12-2001", "1-2-2001", "25/6/2001", "13/1/1950")],
    *[(m, lambda m: date(m, "mdy")) for m in ("05/12/2001", "12/31/2001", "1/2/2001", "1/31/1999")],
    *[(m, lambda m: date(m, "ymd")) for m in ("2001-12-31", "2001/12/31")],
    *[(m, ip6) for m in ("2001:db8::ff00:42:8329", "fe80::1", "2001:0db8:0000:0000:0000:ff00:0042:8329", "1:2:3:4:5:6:7:8")],
]
#: Nothing that is anyone's.
PLAIN = [
    "std::vector<int> a::b :: ::1 12:34:56 10:20", "100 200 3000 and 12 345 6789", "2020 123 4567 2.0.1", "13/13/2001 30/02/2001 0/5/2001 31-02-2001",
    "1 2 3 4 5 6 7 8 9", "007 and 03 and 0 12", "+5 points, +12 %", "page 0123", "ratio 1:2:3", "00 11", "sum 1.2 + 3.4",
]


def run(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    found = {r.doc_id: r for r in pseudonymised(df, KEY, count="n").collect()}
    return [(found[i].text, found[i].n) for i in range(len(texts))]


def test_every_form_as_in_plain_python(spark):
    frames = ["{}", "x {} y", "({}), then", "a: {}."]
    texts = [f.format(m) for m, _ in CASES for f in frames]
    for (text, n), (m, f, make) in zip(run(spark, texts), [(m, f, make) for m, make in CASES for f in frames]):
        assert text == f.format(make(m)) and n == 1 and make(m) != m, (f.format(m), text)


def test_what_is_not_personal_stays(spark):
    assert run(spark, PLAIN) == [(t, 0) for t in PLAIN]


def test_numbers_and_dates_stay_linked_in_any_layout(spark):
    same = ["+4915112345678", "+49 151 12345678", "+49 15 1123 45678", "+49-151-12345678"]
    assert len({re.sub(r"\D", "", t) for t, _ in run(spark, same)}) == 1
    iso, dots, dash, us, short = (t for t, _ in run(spark, ["2001-12-31", "31.12.2001", "31-12-2001", "12/31/2001", "31.12.2001 x"]))
    y, m, d = iso.split("-")
    assert (dots, dash, us, short) == (f"{d}.{m}.{y}", f"{d}-{m}-{y}", f"{m}/{d}/{y}", f"{d}.{m}.{y} x")
    full, cut = (t for t, _ in run(spark, ["2001:0db8:0:0:0:0:0:1", "2001:db8::1"]))
    assert full == cut


def test_dates_of_one_layout_stay_different(spark):
    days = [datetime.date(2000, 1, 1) + datetime.timedelta(days=n) for n in range(400)]
    texts = [d.strftime("%d/%m/%Y") for d in days if d.day > 12] + [d.strftime("%m/%d/%Y") for d in days]
    assert len({t for t, _ in run(spark, texts)}) == len(texts)


@pytest.mark.parametrize("mail", ["jürgen@müller.de", "ÉLODIE.Noël+7@exemple.fr", "straße@x.org", "a_b-c%d@mail.co.uk"])
def test_letters_outside_ascii_do_not_stay(spark, mail):
    ((text, n),) = run(spark, [f"to {mail}, please"])
    new = re.fullmatch(r"to (\S+), please", text)[1]
    assert n == 1 and len(new) == len(mail) and new.rsplit(".", 1)[1] == mail.rsplit(".", 1)[1]
    body = list(zip(mail.rsplit(".", 1)[0], new.rsplit(".", 1)[0]))
    assert all((a == b) == (not a.isalnum()) or a.isalnum() for a, b in body)
    assert all(b.isalpha() for a, b in body if a.isalpha()) and sum(a == b for a, b in body if a.isalpha()) <= 2
    assert run(spark, [mail.lower()])[0][0] == new.lower()
