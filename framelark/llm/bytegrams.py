"""Hashed character n-grams of whole texts, as numpy arrays over the bytes of many texts at once."""

from __future__ import annotations

import re
import unicodedata

import numpy as np

SPACE = 32
#: Bytes kept as they are: a to z and everything outside ASCII. The rest becomes a space.
_KEEP = np.zeros(256, bool)
_KEEP[97:123] = True
_KEEP[128:] = True
#: Letters, and number signs such as ² or Ⅷ, which are none.
_ALMOST = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """If any character is a letter (its Unicode category begins with L)."""
    return bool(text) and any(unicodedata.category(m[0])[0] == "L" for m in _ALMOST.finditer(text))


def stream(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, with runs of other characters as one space, and each byte's text number.

    Every text begins and ends with a space, so no n-gram without an inner space crosses from one text to the next.
    """
    parts = [(" " + (t or "").lower() + " ").encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
    data = np.where(_KEEP[data], data, np.uint8(SPACE))
    inner = np.ones(len(data), bool)
    inner[1:] = (data[1:] != SPACE) | (data[:-1] != SPACE) | (owner[1:] != owner[:-1])
    return data[inner], owner[inner]


def grams(data: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash below 2**bits) of the n-grams whose inner bytes are not spaces."""
    m = len(data) - n + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = np.full(m, n, np.uint32)
    good = np.ones(m, bool)
    for k in range(n):
        code *= np.uint32(257)
        code += data[k : k + m]
        if 0 < k < n - 1:
            good &= data[k : k + m] != SPACE
    if n == 2:
        good &= (data[:m] != SPACE) | (data[1 : 1 + m] != SPACE)
    code *= np.uint32(2654435769)
    at = np.flatnonzero(good)
    return at, (code[at] >> np.uint32(32 - bits)).astype(np.int64)
