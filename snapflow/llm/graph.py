"""Connected components of a graph that lives in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.session import discard, settled


def components(edges: DataFrame, scratch: list[str]) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; root is the component's smallest node.

    Alternating large-star and small-star rounds: each replaces a node's links by links to its smallest neighbour,
    so the number of links never grows and the rounds are logarithmic in practice. Minima are pre-aggregated before
    the shuffle, and a round's links are written to the shared folder, so that neither a hot node nor a lost executor
    gathers or repeats the whole graph. Self-loops and repeated links are harmless; no edges give no rows.
    """
    spark = edges.sparkSession
    mine: list[str] = []

    def both(e: DataFrame) -> DataFrame:
        return e.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")

    def linked(e: DataFrame, links: DataFrame) -> DataFrame:
        """Each node's links with its minimum; the cast key keeps both join inputs plain exchanges, which can be split."""
        least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").cast("string").alias("k"), F.least("a", "m").alias("m"))
        return links.withColumn("k", F.col("a").cast("string")).join(least, "k")

    current = settled(edges.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), mine)
    before = None
    while True:
        large = linked(current, both(current)).filter(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b")
        large = large.filter(F.col("a") != F.col("b")).distinct()
        down = large.select(F.col("b").alias("a"), F.col("a").alias("b"))  # from a node to its smaller neighbours
        small = linked(large, down).select(F.col("m").alias("p"), F.explode(F.array("a", "b")).alias("b")).select(F.col("p").alias("a"), "b")
        following = settled(small.filter(F.col("a") != F.col("b")).distinct(), mine)
        state = following.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        current = following
        if state == before:
            break
        before = state
    done = settled(current.select(F.explode(F.array(F.struct(F.col("b").alias("node"), F.col("a").alias("root")),
                                                    F.struct(F.col("a").alias("node"), F.col("a").alias("root")))).alias("n")).select("n.*").distinct(), scratch)
    discard(spark, mine)
    return done
