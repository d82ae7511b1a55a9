"""Raw documents to packed training sequences.

Each stage is one operator of ``framelark.llm``. It takes the documents that the one before kept and, but for the last,
returns documents of the same columns; the driver writes every stage's result and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark.llm import language, mixing, neardup, packing, pseudonyms, tokens
from framelark.llm.queries import PIECE_ORDER, PSEUDONYM_KEY
from framelark.session import staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that belong to no language: texts without letters and those too far from every centroid."""
    model = language.fit(docs)
    rejected = F.coalesce(language.predicted(model).getField("rejected"), F.lit(True))
    return docs.filter(~rejected)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each class of near copies."""
    return neardup.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal values by pseudonyms of their format."""
    return pseudonyms.pseudonymised(docs, PSEUDONYM_KEY)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's target wants it; documents taken twice are two rows."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, one row per piece."""
    return packing.pack(tokens.token_pieces(docs), PIECE_ORDER)


STAGES = [
    ("language ID", language_id),
    ("near copies", near_copies),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("best-fit packing", best_fit_packing),
]
#: Learned centroids and tokens are not SQL; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
