"""Connected components of links between keys, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabwright.functions.state import cut_lineage
from tabwright.llm.staging import staged


def _lowest(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour, summed up before the shuffle, and written, so that joins to it can split hot nodes."""
    return staged(edges.groupBy("a").agg(F.min("b").alias("low")), "lowest")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the smallest node that can be reached.

    Each round points larger neighbours at the smallest neighbour (large star), then smaller ones (small star). A node
    with many links is one row of an aggregate and a plain join that adaptive execution may split. Rounds are
    checkpointed; they end when the links no longer change. Self links and nulls are left out.
    """
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            both.join(_lowest(both), "a").select(F.col("b").alias("x"), F.least("a", "low").alias("y"), "a")
            .where("x > a AND x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        )
        small = (
            large.join(_lowest(large), "a")
            .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct()
        )
        edges = cut_lineage(small)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
