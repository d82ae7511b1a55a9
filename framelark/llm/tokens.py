"""Documents to token ids, cut in pieces of at most one sequence.

A document is the ids of its whole text followed by an end id. Only documents longer than a sequence are cut: all
pieces but the first are full, so that one piece per document is left to pack.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

END_ID = 2
SEQUENCE = 1024
TOKENIZER = "byte_bpe_50k.json"
PIECE = "piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=4)
def encoder(name: str = TOKENIZER) -> Callable[[str], list[int]]:
    """Token ids of a text by a public tokenizer file, special tokens not added.

    The byte-level vocabulary is published in two forms; the rank form gives the same ids four times as fast
    (compared over every code point in the tests). Texts with a special token's string go to the JSON form, which
    reads it as that token.
    """
    import public_tokenizers
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public_tokenizers.path(name))
    if name != TOKENIZER:
        return lambda text: full.encode(text, add_special_tokens=False).ids
    import tiktoken

    with open(public_tokenizers.path(name.replace(".json", ".tiktoken")), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = [token.content for token in full.get_added_tokens_decoder().values()]

    def ids(text: str) -> list[int]:
        if any(s in text for s in special):
            return full.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return ids


def pieces_of(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the remainder first, then full ones."""
    first = n % most or min(n, most)
    return [(0, first)] + [(start, most) for start in range(first, n, most)]


def token_pieces(
    docs: DataFrame,
    text: str = "text",
    most: int = SEQUENCE,
    tokenizer: str = TOKENIZER,
    keep_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every document.

    A null text is an empty one: the end id alone. Repeated rows give repeated pieces. Columns of ``docs`` other than
    ``doc_id`` and the text are not read. No rows give no rows.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = encoder(tokenizer)
        for pdf in batches:
            rows = []
            for doc_id, words in zip(pdf["doc_id"], pdf["text"]):
                ids = np.asarray([*(ids_of(words) if words else ()), END_ID], "<u4")
                for k, (start, n) in enumerate(pieces_of(len(ids), most)):
                    part = ids[start : start + n]
                    row = (doc_id, k, start, n, zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if keep_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if keep_ids else 5]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    schema = "doc_id long, " + PIECE + (", ids array<int>" if keep_ids else "")
    narrow = docs.selectExpr("cast(doc_id as long) as doc_id", f"`{text}` as text")
    return narrow.mapInPandas(cut, schema)
