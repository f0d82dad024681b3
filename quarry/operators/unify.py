"""Merging two sources of one kind of record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_sources(left: DataFrame, right: DataFrame, key: str, size: Column, topic: str, names: tuple[str, str]) -> DataFrame:
    """One row for each key of either side: the longer record (the left one of equals), an empty topic filled from the other, and the list of sources.

    `size` measures a record; keys are unique on either side. Both sides are joined whole by key.
    """
    columns = [c for c in left.columns if c != key]
    a = left.select(F.col(key).alias("__ka"), F.struct(size.alias("__size"), *columns).alias("__a"))
    b = right.select(F.col(key).alias("__kb"), F.struct(size.alias("__size"), *columns).alias("__b"))
    both = a.join(b, F.col("__ka") == F.col("__kb"), "full_outer")
    win = F.when(F.col("__b").isNull() | (F.col("__a.__size") >= F.col("__b.__size")), F.col("__a")).otherwise(F.col("__b"))
    other = F.when(F.col("__b").isNull() | (F.col("__a.__size") >= F.col("__b.__size")), F.col("__b")).otherwise(F.col("__a"))
    picked = both.select(F.coalesce("__ka", "__kb").alias(key), win.alias("__w"), other.alias("__o"), F.filter(F.array(F.when(F.col("__ka").isNotNull(), names[0]), F.when(F.col("__kb").isNotNull(), names[1])), lambda x: x.isNotNull()).alias("sources"))
    filled = F.coalesce(F.nullif(F.col(f"__w.{topic}"), F.lit("")), F.nullif(F.col(f"__o.{topic}"), F.lit("")), F.lit(""))
    return picked.select(key, *(filled.alias(c) if c == topic else F.col(f"__w.{c}").alias(c) for c in columns), "sources")


def put_field(df: DataFrame, struct: str, name: str, value: Column, after: str) -> DataFrame:
    """`df` with a field set in a struct, behind the field `after`; the others keep their order."""
    fields = [f for f in df.schema[struct].dataType.fieldNames() if f != name]
    at = fields.index(after) + 1
    ordered = fields[:at] + [name] + fields[at:]
    return df.withColumn(struct, F.struct(*(value.alias(f) if f == name else F.col(f"{struct}.{f}").alias(f) for f in ordered)))
