"""Traversal of a graph kept as node and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import first_n


def hop(bound: DataFrame, edges: DataFrame, rel: str | None = None, out: bool = True) -> DataFrame:
    """Distinct (src, dst) pairs that lead from the nodes `bound` (id) over one edge; `out` is the direction."""
    a, b = ("src", "dst") if out else ("dst", "src")
    rows = edges.where(F.col("rel") == rel) if rel else edges
    return rows.select(F.col(a).alias("src"), F.col(b).alias("dst")).join(bound.select(F.col("id").alias("src")).distinct(), "src", "left_semi").distinct()


def first_hops(pairs: DataFrame, n: int = 30) -> DataFrame:
    """At most n targets of each source, by id."""
    return first_n(pairs, ["src"], ["dst"], n)


def chain(bound: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """(src, mid, dst) over two edges."""
    one = hop(bound, first).withColumnRenamed("dst", "mid")
    two = second.select(F.col("src").alias("__mid"), F.col("dst").alias("__dst")).distinct()
    return one.join(two, F.col("mid") == F.col("__mid")).select("src", "mid", F.col("__dst").alias("dst"))


def optional(left: DataFrame, edges: DataFrame, column: str, name: str) -> DataFrame:
    """`left` with the targets of its column, null where there is none."""
    two = edges.select(F.col("src").alias("__s"), F.col("dst").alias(name)).distinct()
    return left.join(two, F.col(column) == F.col("__s"), "left").drop("__s")


def neighbourhood(start: DataFrame, edges: DataFrame, hops: int = 2) -> DataFrame:
    """id, distance of all nodes within so many hops either way."""
    both = edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    seen = front = start.select("id").distinct().withColumn("distance", F.lit(0))
    for k in range(1, hops + 1):
        near = both.join(front.select(F.col("id").alias("src")), "src", "left_semi").select(F.col("dst").alias("id")).distinct()
        front = near.join(seen, "id", "left_anti").withColumn("distance", F.lit(k))
        seen = seen.unionByName(front)
    return seen


def degrees(edges: DataFrame, anchor: str = "dst") -> DataFrame:
    """anchor, degree: distinct neighbours of each anchor."""
    other = "src" if anchor == "dst" else "dst"
    return edges.select(F.col(anchor).alias("anchor"), F.col(other).alias("o")).distinct().groupBy("anchor").agg(F.count("*").alias("degree"))


def shared_anchor(edges: DataFrame, most: int = 8) -> DataFrame:
    """(src, anchor, other): other sources of an anchor. Anchors of a degree above `most` are left out first: that is the operator's bound, and what keeps the pairs of an anchor few."""
    few = degrees(edges).where(F.col("degree").between(2, most)).select("anchor")
    pairs = edges.select("src", F.col("dst").alias("anchor")).distinct().join(few, "anchor", "left_semi")
    other = pairs.select(F.col("src").alias("other"), F.col("anchor").alias("__anchor"))
    return pairs.join(other, F.col("anchor") == F.col("__anchor")).where("src <> other").select("src", "anchor", "other")


def collected(pairs: DataFrame, key: str, value: Column, order: Column, n: int, name: str, separator: str = "、") -> DataFrame:
    """key and the first n values in the order, joined: limited before they are collected."""
    rows = pairs.select(F.col(key).alias("__k"), value.alias("__v"), order.alias("__o")).distinct()
    top = first_n(rows, ["__k"], ["__o", "__v"], n)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("__o", "__v"))), lambda x: x["__v"])
    return top.groupBy(F.col("__k").alias(key)).agg(F.array_join(listed, separator).alias(name))
