"""Deduplication that says which row stays. A window's rank is limited before the shuffle, so that a hot key sends few rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranked(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column | str]) -> DataFrame:
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_wins(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column | str]) -> DataFrame:
    """Of the rows with equal keys the first in the order."""
    return _ranked(df, keys, order).where("__rank = 1").drop("__rank")


def last_wins(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """An upsert's result: of the rows with equal keys the last in the order."""
    return first_wins(df, keys, [F.desc(c) for c in order])


def first_n(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column | str], n: int) -> DataFrame:
    return _ranked(df, keys, order).where(F.col("__rank") <= n).drop("__rank")


def prefer_filled(df: DataFrame, keys: Sequence[str], filled: Column, seq: str) -> DataFrame:
    """Of the rows with equal keys the first whose attribute is filled, else the first; `position` is where the key first stood."""
    best = F.min_by(F.struct(*df.columns), F.struct((~F.coalesce(filled, F.lit(False))).alias("none"), F.col(seq)))
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(best.alias("__row"), F.min(seq).alias("position")).select("__row.*", "position")


def with_occurrences(df: DataFrame, key: str | Column, seq: str, name: str = "occurrences") -> DataFrame:
    """First rows with the number of all rows of their key: counted by partial sums, not by a window over a hot key."""
    key = F.col(key) if isinstance(key, str) else key
    best = F.min_by(F.struct(*df.columns), F.col(seq))
    return df.groupBy(key.alias("__key")).agg(best.alias("__row"), F.count("*").alias(name)).select("__row.*", name)


def across_groups(df: DataFrame, key: Column, group: str) -> DataFrame:
    """Keys that stand in more than one group: key, groups, rows, surplus."""
    by_group = df.groupBy(key.alias("key"), group).agg(F.count("*").alias("n"))
    return by_group.groupBy("key").agg(F.count("*").alias("groups"), F.sum("n").alias("rows")).where("groups > 1").withColumn("surplus", F.col("rows") - 1)


def bag_match(left: DataFrame, right: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Rows of two bags matched one to one: the n-th of a key meets the n-th. Gives keys, left_seq, right_seq; null where one side has none."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(seq))
    a = left.select(*[F.col(k).alias(f"__a_{k}") for k in keys], F.col(seq).alias("left_seq"), number.alias("__an"))
    b = right.select(*[F.col(k).alias(f"__b_{k}") for k in keys], F.col(seq).alias("right_seq"), number.alias("__bn"))
    on = F.col("__an") == F.col("__bn")
    for k in keys:
        on = on & (F.col(f"__a_{k}") == F.col(f"__b_{k}"))
    return a.join(b, on, "full_outer").select(*[F.coalesce(f"__a_{k}", f"__b_{k}").alias(k) for k in keys], "left_seq", "right_seq")


def group_in_order(df: DataFrame, key: str, order: str, most: int | None = None) -> DataFrame:
    """key and its rows as a list in their order; `most` bounds a key's list by its first rows, before the shuffle."""
    rows = first_n(df, [key], [order], most) if most else df
    place = F.struct(F.col(order).alias("__o"), F.struct(*[c for c in df.columns if c != key]).alias("__r"))
    return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(place)), lambda x: x["__r"]).alias("rows"))
