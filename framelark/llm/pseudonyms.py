"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

A value is a row of small numbers, each below a limit of its own (a digit below 10, an octet below 256, a letter below
26). The row is cut in two halves. In each of eight rounds every number of one half is shifted, modulo its limit, by a
keyed hash of the other half and of its place; halves take turns. Each round can be undone with the key, so the whole is
a permutation of the values of that format: equal values have equal pseudonyms in all documents, and different values
different ones. Punctuation, letter case and check digits are put back afterwards.

Only validated values are touched:

- e-mail addresses: letters (a to z and ß to ÿ) and digits of all but the last domain label;
- payment cards of 13 to 19 digits, with or without separators, that pass the Luhn check: the check digit is recomputed;
- social security numbers: area, group and serial number stay in their ranges;
- telephone numbers of 7 to 15 digits: with a country code in front, which stays (it is read from the list of codes, so
  that a number is linked however it is spaced), with an area code in parentheses, as 555-123-4567 or 555 123 4567 with
  any one separator, or with a leading 0 and at least five digits after the area code;
- IPv4 addresses, and IPv6 addresses, whose pseudonyms have all eight groups;
- dates from 1900 to 2099 as 2001-12-31, 2001/12/31, 31.12.2001, 31-12-2001 or 12/31/2001, with one or two digits for day and
  month. With slashes the month comes first; where that is no date, the day does, and its pseudonym is one that can
  only be read so too;
- hexadecimal credentials of 32 to 64 digits after the words token, secret, key or password.

Left alone are names, postal addresses, account numbers other than cards, dates with month names or two-digit years,
and telephone numbers without separators and without a country code.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.functions.once import once
from framelark.llm.common import columns_of, unused

ROUNDS = 8
EMAIL = r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]{1,64}+@(?:[\p{L}0-9-]{1,63}+\.)+[A-Za-z]{2,24}(?![\p{L}0-9-])"
SECRET = r"""(?<![A-Za-z])(?i:token|secret|key|password)\s{0,3}[=:]\s{0,3}["']?[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])"""
IP = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
IP6 = (
    r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?=[0-9A-Fa-f:]{3,39}(?![0-9A-Za-z:]|\.\d))(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)"
    r"(?![0-9A-Za-z:]|\.\d)"
)
DATE = (
    r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4}|\d{1,2}/\d{1,2}/\d{4})"
    r"(?![./-]?\d)"
)
PHONE = (
    r"(?<![\d+(.-])(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\d+.-])(?:\+\d{1,3}[ .-])?\d{3}([.-])\d{3}[.-]\d{4}(?![\d-])"
    r"|(?<![\d+])\+\d{1,4}(?:[ .-]?\(0\))?(?:[ ./-]\d{1,8}){1,6}(?!\d)|(?<![\d+])\+\d{8,15}(?!\d)"
    r"|(?<![\d+.,/-])(?<!\d )[2-9]\d{2} \d{3} \d{4}(?! ?\d|[.,-]\d)"
    r"|(?<![\d+.,/-])(?<!\d )0\d{1,4}[ /-]\d{5,8}(?! ?\d|[.,-]\d)"
    r"|(?<![\d+.,/-])(?<!\d )0\d{1,4}[ /-]\d{2,4}(?:[ -]\d{2,4}){1,3}(?! ?\d|[.,-]\d)"
).replace("([.-])", "[.-]")
CARD = r"(?<![\d.+-])\d(?:[ -]?\d){12,18}(?![\d]|[.-]\d)"
ANY = "|".join([EMAIL, SECRET, IP, IP6, SSN, DATE, PHONE, CARD])
#: Days from 1900-01-01 to 2099-12-31 are 229 times 319.
DAYS = (229, 319)
#: Layouts of dates: what a text must look like, and the pattern for it if all parts have two digits, and if not.
LAYOUTS = (
    (r"^\d{4}-", "yyyy-MM-dd", "yyyy-MM-dd"),
    (r"^\d{4}/", "yyyy/MM/dd", "yyyy/MM/dd"),
    (r"^\d{1,2}\.", "dd.MM.yyyy", "d.M.yyyy"),
    (r"^\d{1,2}-", "dd-MM-yyyy", "d-M-yyyy"),
    (r"^\d{1,2}/", "MM/dd/yyyy", "M/d/yyyy"),
    (r"^\d{1,2}/", "dd/MM/yyyy", "d/M/yyyy"),
)
#: The place of the layout that counts only where the one before it gives no date.
DAY_FIRST = 5
#: Country codes of one digit, and of two; all others have three.
ONE_DIGIT = ("1", "7")
TWO_DIGITS = (
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52",
    "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92",
    "93", "94", "95", "98",
)
#: Latin letters from ß or à to ÿ, without the division sign among them.
FIRST, LAST, NO_LETTER = 223, 255, 247
#: Steps after which a walk to the next date with a day above 12 is given up; three in five dates have one.
WALK = 200


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def permuted(values: Column, limits: Column, kind: str, key: str) -> Column:
    """The numbers after all rounds; ``values`` and ``limits`` are arrays of bigint of one length."""

    def rounds(start: Column) -> Column:
        """``start``: numbers and their limits."""
        limit, half = start.getField("limit"), F.call_function("div", F.size(start.getField("limit")), F.lit(2))

        def turn(state: Column, number: Column) -> Column:
            first = number % 2 == 0
            other = F.array_join(F.filter(state, lambda _, i: (i < half) != first).cast("array<string>"), ",")

            def shifted(ground: Column) -> Column:
                def moved(value: Column, i: Column) -> Column:
                    text = F.concat_ws("|", ground, i.cast("string"))
                    shift = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 12), 16, 10).cast("bigint")
                    return F.when((i < half) == first, (value + shift) % F.get(limit, i)).otherwise(value)

                return F.transform(state, moved)

            return let(F.concat_ws("|", F.lit(key), F.lit(kind), number.cast("string"), other), shifted)

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start.getField("value"), turn)

    return let(F.struct(values.alias("value"), limits.alias("limit")), rounds)


def characters(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def as_numbers(digits: Column) -> Column:
    return F.transform(characters(digits), lambda c: c.cast("bigint"))


def permuted_digits(digits: Column, kind: str, key: str) -> Column:
    limits = F.array_repeat(F.lit(10).cast("bigint"), F.length(digits))
    return F.array_join(permuted(as_numbers(digits), limits, kind, key).cast("array<string>"), "")


def in_layout(layout: Column, digits: Column) -> Column:
    """``layout`` with its digits replaced one after the other."""

    def filled(new: Column) -> Column:
        def put(c: Column, i: Column) -> Column:
            place = F.length(digits_of(F.substring(layout, F.lit(1), i + 1)))
            return F.when(c.rlike("[0-9]"), F.substring(new, place, F.lit(1))).otherwise(c)

        return F.array_join(F.transform(characters(layout), put), "")

    return let(digits, filled)


def permuted_letters(text: Column, letters: int, kind: str, key: str) -> Column:
    """Digits among digits, the first ``letters`` letters and those from ß to ÿ among themselves; case and all else stay."""
    cs = characters(text)
    lower = F.transform(cs, lambda c: F.ascii(F.lower(c)).cast("bigint"))
    is_digit, is_letter = lambda c: c.between(48, 57), lambda c: c.between(97, 96 + letters)
    is_more = lambda c: c.between(FIRST, LAST) & (c != NO_LETTER)
    more = lambda c: c - FIRST - F.when(c > NO_LETTER, 1).otherwise(0)
    values = F.transform(
        lower, lambda c: F.when(is_digit(c), c - 48).when(is_letter(c), c - 97).when(is_more(c), more(c)).otherwise(F.lit(0).cast("bigint"))
    )
    limits = F.transform(
        lower,
        lambda c: F.when(is_digit(c), 10).when(is_letter(c), letters).when(is_more(c), LAST - FIRST).otherwise(1).cast("bigint"),
    )
    both = F.arrays_zip(cs.alias("c"), lower.alias("l"), permuted(values, limits, kind, key).alias("v"))

    def back(pair: Column) -> Column:
        c, v = pair.getField("c"), pair.getField("v")
        code = v + FIRST + F.when(v >= NO_LETTER - FIRST, 1).otherwise(0)
        # ß and ÿ have no capital of one character, so these letters are all written small.
        written = F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")
        return (
            F.when(c.rlike("[0-9]"), v.cast("string"))
            .when(c.rlike("[a-z]"), F.char(v + 97))
            .when(c.rlike("[A-Z]"), F.char(v + 65))
            .when(is_more(pair.getField("l")), written)
            .otherwise(c)
        )

    return F.array_join(F.transform(both, back), "")


def luhn_digit(payload: Column) -> Column:
    """The digit that completes the number: every second digit from the right is doubled, digits are summed."""

    def added(total: Column, digit: Column) -> Column:
        twice = digit * 2
        value = F.when(total.getField("turn") == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)
        return F.struct((total.getField("sum") + value).alias("sum"), (1 - total.getField("turn")).alias("turn"))

    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("turn"))
    return F.aggregate(as_numbers(F.reverse(payload)), start, added, lambda t: F.pmod(-t.getField("sum"), F.lit(10)).cast("string"))


def part(text: Column, start: Column | int, length: Column) -> Column:
    return F.substring(text, F.lit(start) if isinstance(start, int) else start, length)


def card(m: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        payload = part(digits, 1, F.length(digits) - 1)
        valid = (luhn_digit(payload) == F.right(digits, F.lit(1))) & ~digits.rlike(r"^(\d)\1*$")
        new = let(permuted_digits(payload, "card", key), lambda p: F.concat(p, luhn_digit(p)))
        return F.when(valid, in_layout(m, new))

    return let(digits_of(m), of)


def email(m: Column, key: str) -> Column:
    top = F.regexp_extract(m, r"\.[A-Za-z]+$", 0)
    return F.concat(permuted_letters(part(m, 1, F.length(m) - F.length(top)), 26, "email", key), top)


def secret(m: Column, key: str) -> Column:
    body = F.regexp_extract(m, "[0-9A-Fa-f]{32,64}$", 0)
    return F.concat(part(m, 1, F.length(m) - F.length(body)), permuted_letters(body, 6, "secret", key))


def ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("bigint"))
    new = permuted(octets, F.array_repeat(F.lit(256).cast("bigint"), 4), "ip", key)
    return F.when(F.forall(octets, lambda o: o < 256), F.array_join(new.cast("array<string>"), "."))


def ssn(m: Column, key: str) -> Column:
    """Areas are 001 to 899 without 666; groups and serial numbers are not zero."""
    area, group, serial = (part(m, a, F.lit(n)).cast("bigint") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    limits = F.array(*(F.lit(n).cast("bigint") for n in (898, 99, 9999)))
    ranks = F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1)

    def written(new: Column) -> Column:
        one, two, three = (F.get(new, F.lit(k)) + 1 for k in range(3))
        one = F.when(one >= 666, one + 1).otherwise(one)
        return F.concat_ws("-", *(F.lpad(n.cast("string"), w, "0") for n, w in ((one, 3), (two, 2), (three, 4))))

    return F.when(valid, let(permuted(ranks, limits, "ssn", key), written))


def ip6(m: Column, key: str) -> Column:
    """All eight groups are permuted; groups that ``::`` stands for are zeros."""
    zero = F.lit("0")
    head, tail = F.split(F.regexp_extract(m, "^(.*?)::", 1), ":"), F.split(F.regexp_extract(m, "::(.*)$", 1), ":")
    filled = lambda part: F.filter(part, lambda g: g != "")
    short = F.contains(m, F.lit("::"))
    missing = 8 - F.size(filled(head)) - F.size(filled(tail))
    groups = F.when(short, F.concat(filled(head), F.array_repeat(zero, F.greatest(missing, F.lit(0))), filled(tail))).otherwise(F.split(m, ":"))

    def of(parts: Column) -> Column:
        numbers = F.transform(parts, lambda g: F.conv(g, 16, 10).cast("bigint"))
        new = permuted(numbers, F.array_repeat(F.lit(65536).cast("bigint"), 8), "ip6", key)
        text = F.array_join(F.transform(new, lambda n: F.lower(F.hex(n))), ":")
        # Two colons with nothing around them are no address, nor are the unspecified and the loopback address anyone's.
        someone = F.exists(F.slice(numbers, 1, 7), lambda n: n > 0) | (F.get(numbers, F.lit(7)) > 1)
        return F.when((F.size(parts) == 8) & (~short | (missing > 0)) & someone & m.rlike("[0-9]"), text)

    return let(groups, of)


def phone(m: Column, key: str) -> Column:
    """The country code is read from the digits, not from the spacing, so equal numbers stay linked in any layout."""

    def of(digits: Column) -> Column:
        two = F.substring(digits, 1, 2)
        n = F.when(F.left(digits, F.lit(1)).isin(*ONE_DIGIT), 1).when(two.isin(*TWO_DIGITS), 2).otherwise(3)
        code = F.when(F.startswith(m, F.lit("+")), n).otherwise(0)
        own = F.length(digits) - code
        rest = part(digits, code + 1, own)
        new = F.concat(part(digits, 1, code), permuted_digits(rest, "phone", key))
        return F.when(F.length(digits).between(7, 15) & (own >= 4), in_layout(m, new))

    # A trunk zero in parentheses after the country code is part of no number.
    return let(digits_of(m), of)


def date(m: Column, key: str) -> Column:
    first = F.lit("1900-01-01").cast("date")
    limits = F.array(*(F.lit(n).cast("bigint") for n in DAYS))
    two = m.rlike(r"^\d\d[./-]\d\d[./-]")

    def moved(day: Column) -> Column:
        new = permuted(F.array(day % DAYS[0], F.call_function("div", day, F.lit(DAYS[0]))), limits, "date", key)
        return let(new, lambda n: F.get(n, F.lit(0)) + F.get(n, F.lit(1)) * DAYS[0])

    def read(form: str) -> Column:
        day = F.datediff(F.try_to_date(m, form), first).cast("bigint")
        return let(day, lambda d: F.when(d.between(0, DAYS[0] * DAYS[1] - 1), d))

    def written(day: Column, k: Column) -> Column:
        at = F.date_add(first, day.cast("int"))
        forms = [F.when(k == i, F.when(two, F.date_format(at, padded)).otherwise(F.date_format(at, short))) for i, (_, padded, short) in enumerate(LAYOUTS)]
        return F.coalesce(*forms)

    def of(found: Column) -> Column:
        day, k = found.getField("day"), found.getField("k")

        def step(now: Column, n: Column) -> Column:
            settled = (n > 0) & (F.dayofmonth(F.date_add(first, now.cast("int"))) > 12)
            return F.when(settled, now).otherwise(moved(now))

        # A text that has to be read day first is permuted until the day is above 12 again: a permutation of those
        # dates, which texts read month first never show.
        steps = F.when(k == DAY_FIRST, WALK).otherwise(0)
        new = F.aggregate(F.sequence(F.lit(0), steps), day, step)
        return F.when(day.isNotNull(), let(new, lambda n: written(n, k)))

    tries = [F.when(m.rlike(look), F.struct(read(short).alias("day"), F.lit(k).alias("k"))) for k, (look, _, short) in enumerate(LAYOUTS)]
    return let(F.coalesce(*[F.when(t.getField("day").isNotNull(), t) for t in tries]), of)


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one value, null if it is none of the kinds or not valid."""
    kinds = ((EMAIL, email), (SECRET, secret), (IP, ip), (IP6, ip6), (SSN, ssn), (DATE, date), (PHONE, phone), (CARD, card))
    found = F
    for pattern, make in kinds:
        found = found.when(m.rlike(f"^(?:{pattern})$"), make(m, key))
    return found


def pseudonymised(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with every personal value in ``text`` replaced; ``count`` names a column for how many were.

    All other columns stay as they are. A text that is null stays null, one without such values stays as it is.
    Numbers that fail their check, and dates that do not exist, are left alone. Nothing is shuffled; the work is
    proportional to the text.
    """
    t = F.col(text)
    (made,) = unused(docs, "_values")
    found = F.regexp_extract_all(t, F.lit(ANY), F.lit(0))
    some = t.rlike("[0-9@]|::") & t.rlike(ANY)
    parts = F.struct(found.alias("old"), F.transform(found, lambda m: pseudonym(m, key)).alias("new"))
    # The texts without any value skip all of this; for the others the names are made once.
    rows = docs.withColumn(made, once(F.when(some, parts)))
    values = F.zip_with(f"{made}.new", f"{made}.old", lambda new, old: F.coalesce(new, old))
    merged = F.array_join(F.zip_with(F.split(t, ANY, -1), values, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    new = F.when(F.col(made).isNotNull(), merged).otherwise(t)
    n = F.coalesce(F.size(F.filter(f"{made}.new", lambda v: v.isNotNull())), F.lit(0))
    names = [c if name != text else new.alias(name) for name, c in zip(docs.columns, columns_of(docs))]
    return rows.select(*names, *([n.alias(count)] if count else []))
