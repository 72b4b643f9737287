"""Connected components over links between integer keys, and size-checked joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardlight.session import settled

# A side with at most this many rows of one key (some 16 MB) may be broadcast.
BROADCAST_ROWS = 1 << 20


def with_few(rows: DataFrame, few: DataFrame, key: str, how: str) -> DataFrame:
    """Join of wide rows with a one-column table, broadcast only if its counted size allows.

    Beyond the limit both sides are shuffled; the result is the same.
    """
    small = few.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(few) if small else few, key, how)


def _all_hang_on_roots(edges: DataFrame) -> bool:
    """Whether every node has one edge at most, to a node that has none itself."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("root"))
    ends = ends.unionByName(edges.select(
        F.col("v").alias("n"), F.lit(0).alias("child"), F.lit(1).alias("root")))
    return (ends.groupBy("n").agg(F.sum("child").alias("edges"), F.max("root").alias("root"))
            .where((F.col("edges") > 1) | ((F.col("edges") > 0) & (F.col("root") > 0))).isEmpty())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node of ``links`` (a, b)
    that is not a root itself.

    Rounds of large-star and small-star steps: each node's larger neighbours, then
    its smaller ones, are hung on its smallest neighbour, until all hang on
    their root; links that do already need no round. A round is two aggregations that combine before they shuffle,
    and a hot node is a skewed join side that may be split; the number of rounds
    grows with the logarithm of the graph.
    """
    edges = settled(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _all_hang_on_roots(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lowest.select("u", F.col("m").alias("v"))).distinct()
        edges = settled(small.where(F.col("u") != F.col("v")), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
