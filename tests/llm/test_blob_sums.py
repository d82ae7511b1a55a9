"""Arrays that tasks send to be added up: no task holds many of them whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelark.llm import common, maxent


def test_model_arrays_are_added_in_pieces(spark, monkeypatch):
    longest, plain = [], common.sum_blobs

    def watched(df, keys, value, *rest, **named):
        longest.append(df.agg(F.max(F.length(value))).first()[0] or 0)
        return plain(df, keys, value, *rest, **named)

    for module in (common, maxent):
        if hasattr(module, "sum_blobs"):
            monkeypatch.setattr(module, "sum_blobs", watched)
    rows = [(i, " ".join(f"w{(i * k) % 13}" for k in range(20))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert maxent.scores(docs, F.col("doc_id") % 5 == 1).count() == 60
    # Two tables of counts, then the weights of each round that has a chunk; 32 pieces of 512 KB at most meet in a task.
    assert len(longest) >= 3 and 0 < max(longest) <= 1 << 19


@pytest.mark.parametrize("n, piece_bytes", [(1, 8), (7, 16), (8, 16), (1000, 1 << 19), (5000, 4096)])
def test_pieces_make_the_whole_sum(spark, n, piece_bytes):
    arrays = [np.arange(n, dtype="<f8") * (i + 1) for i in range(9)]
    df = spark.createDataFrame([(bytearray(a.tobytes()),) for a in arrays], "a binary").repartition(4)
    found = common.summed(df, "a", "<f8", piece_bytes)
    assert found.tolist() == sum(arrays).tolist()
    assert common.summed(df.limit(0), "a") is None
