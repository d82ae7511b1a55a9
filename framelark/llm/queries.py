"""One query for each operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark.llm import fingerprint, language, licences, maxent, neardup, toxicity
from framelark.llm.blockmax import exact_top, exact_top_sql
from framelark.llm.clustering import clusters, clusters_sql
from framelark.llm.common import fold, table
from framelark.llm.mixing import copies
from framelark.llm.packing import pack
from framelark.llm.pseudonyms import pseudonymised
from framelark.llm.search import nearest
from framelark.llm.tokens import token_pieces
from framelark.llm.vectorcodes import compressed, compressed_sql

Query = Callable[[SparkSession, str], DataFrame]
#: A fixed key, so that reruns of the queries agree. Whoever publishes results uses a secret one.
PSEUDONYM_KEY = "framelark-queries"
PIECE_ORDER = ["doc_id", "piece", "start", "ids_crc32"]


def op1_pivotal_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = copies(table(spark, sf, "documents"))
    taken = (F.col("size") * F.col("copies")).cast("long").alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "source", "copies")


def op2_bin_slack_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(token_pieces(table(spark, sf, "documents")), PIECE_ORDER)


def op3_one_bit_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_licence_digests(spark: SparkSession, sf: str) -> DataFrame:
    return licences.scan(table(spark, sf, "documents"))


def op5_feistel_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    found = pseudonymised(table(spark, sf, "documents"), PSEUDONYM_KEY, count="n_replaced")
    return found.select("doc_id", "text", "n_replaced")


def op6_probminhash_near_copies(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.classes(table(spark, sf, "documents")).select("doc_id", "class_id")


def op7_nearest_centroid_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = fold("doc_id", 4) == 2
    model = language.fit(docs.filter(~held_out).select("text", "lang"))
    found = docs.select("doc_id", held_out.alias("held_out"), language.predicted(model).alias("_p"))
    return found.select("doc_id", "held_out", "_p.lang_pred", "_p.score", "_p.rejected")


def op9_subword_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held_out = fold("doc_id", 5) == 0
    model = toxicity.fit(docs, labels.filter(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), toxicity.scored(model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_weighted_sampling_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint.compared(table(spark, sf, "documents"))


def op8_hashed_maxent_scores(spark: SparkSession, sf: str) -> DataFrame:
    return maxent.scores(table(spark, sf, "documents"), fold("doc_id", 5) == 1)


def op11_pivot_table_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return clusters(table(spark, sf, "embeddings")).drop("compared")


def op12_bitmask_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return compressed(table(spark, sf, "embeddings"))


def op13_block_bound_search(spark: SparkSession, sf: str) -> DataFrame:
    return exact_top(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Query] = {
    "op1_pivotal_mixing": op1_pivotal_mixing,
    "op2_bin_slack_packing": op2_bin_slack_packing,
    "op3_one_bit_neighbours": op3_one_bit_neighbours,
    "op4_licence_digests": op4_licence_digests,
    "op5_feistel_pseudonyms": op5_feistel_pseudonyms,
    "op6_probminhash_near_copies": op6_probminhash_near_copies,
    "op7_nearest_centroid_language": op7_nearest_centroid_language,
    "op8_hashed_maxent_scores": op8_hashed_maxent_scores,
    "op9_subword_toxicity": op9_subword_toxicity,
    "op10_weighted_sampling_fingerprints": op10_weighted_sampling_fingerprints,
    "op11_pivot_table_clusters": op11_pivot_table_clusters,
    "op12_bitmask_vector_codes": op12_bitmask_vector_codes,
    "op13_block_bound_search": op13_block_bound_search,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = {
    "op4_licence_digests": licences.scan_sql(),
    "op11_pivot_table_clusters": clusters_sql(),
    "op12_bitmask_vector_codes": compressed_sql(),
    "op13_block_bound_search": exact_top_sql(),
}
