"""Connected components of a graph kept as an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, heavy_limit, stored, weighted_join


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(rows: DataFrame, limit: int) -> DataFrame:
    """Edges a, b with m, the smallest node in a's neighbourhood, a included. A node with very many edges is no task of its own."""
    least = rows.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("a", "m"))
    return weighted_join(rows, "a", least, "n", limit)


def _large_star(edges: DataFrame, limit: int) -> DataFrame:
    """Links each node's larger neighbours to the smallest node of its neighbourhood."""
    return _least(_both(edges), limit).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, limit: int) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    met = _least(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), limit)
    return met.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")


def _settled(edges: DataFrame) -> bool:
    """Whether every component is a star around its smallest node: larger nodes have one edge, and none leads to them."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b): the smallest node that it can reach.

    Each round is written to the shared folder. The number of rounds grows with the logarithm of the graph.
    Empty input: empty output. Loops and repeated edges do no harm.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _settled(now):
        limit = heavy_limit(2 * now.count())
        old, now = now, stored(_small_star(_large_star(now, limit), limit).where("a <> b").distinct(), "edges")
        discard(old)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
