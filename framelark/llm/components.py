"""Connected components of a graph kept as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.session import staged

MOST_ROUNDS = 50


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: every node of ``links`` and the least node of its component.

    Alternates two steps in which links are replaced by links to smaller nodes, until nothing moves: first each node's
    larger neighbours are linked to its least one, then its smaller neighbours and itself are. Rounds grow with the
    logarithm of the longest path. Every round is an aggregate and a join on the node, and is written to the shared
    folder. Links with a null end and links of a node to itself are ignored.
    """
    least, most = F.least(a, b), F.greatest(a, b)
    edges = staged(links.filter(f"{a} <> {b}").select(most.alias("u"), least.alias("v")).distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least_of = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "_u")
        large = (
            both.join(least_of, F.col("u") == F.col("_u")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least_of = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.withColumnRenamed("u", "_u").join(least_of, F.col("_u") == F.col("u"))
        edges = staged(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least_of.select("u", F.col("m").alias("v"))
            ).distinct(),
            "links",
        )
    else:
        raise RuntimeError(f"components not settled after {MOST_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
