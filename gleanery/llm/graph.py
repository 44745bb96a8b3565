"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b, both long), root being the smallest node of its component.

    Each round links every node's larger neighbours to its smallest one, then its smaller ones; rounds end when the set of
    edges stays as it was, by its count and a hash sum. Edges from a node to itself are left out, repeated ones count once.
    """
    links = settled(_down(edges.select("a", "b")))
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = _down(both.where(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        low = large.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = settled(_down(low.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))))
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _down(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, each once."""
    return edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
