"""Connected components by alternating stars, on tables of links only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step: the larger (or smaller) neighbours of every node are tied to the smallest
    node among it and its neighbours."""
    if large:
        near = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
        tied = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        near = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy("a").agg(F.min("b").alias("m"))
        tied = near.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        tied = tied.union(least.select("a", F.col("m").alias("b")))
    return tied.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): every node of the links (a, b) with the smallest node it reaches.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest path.
    """
    current = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = None
    while True:
        current = materialize(_star(_star(current, True), False), "links")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now
