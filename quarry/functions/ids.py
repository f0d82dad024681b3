"""Ids that derive from content, and digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import SPACE, squeeze


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hashed_id(prefix: str, *parts: Column | str, length: int = 24) -> Column:
    """Prefix and the beginning of the md5 of the parts, joined by a bar."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.md5(F.concat_ws("|", *(F.coalesce(_col(p), F.lit("")) for p in parts))), 1, length))


def ordinal_id(parent: Column | str, mark: str, position: Column, width: int = 2) -> Column:
    """parent#P01 and so on; numbers wider than `width` are not cut."""
    number = F.format_string(f"%0{width}d", position.cast("int"))
    return F.concat(_col(parent), F.lit(f"#{mark}"), number)


def safe_component(c: Column | str, empty: Column | None = None) -> Column:
    """White space and anything but word characters, . and - as _, none at the ends; an empty result is a hash, or `empty`."""
    text = squeeze(c)
    safe = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, rf"{SPACE}+", "_"), r"[^\p{L}\p{N}_.-]+", "_"), "^_+|_+$", "")
    return F.when(safe == "", empty if empty is not None else F.substring(F.sha1(text), 1, 16)).otherwise(safe)


def category_id(domain: Column | str, name: Column | str) -> Column:
    return F.concat(F.lit("category:"), _col(domain), F.lit(":"), safe_component(name))


def model_id(domain: Column | str, name: Column | str) -> Column:
    return F.concat(F.lit("model:"), _col(domain), F.lit(":"), safe_component(name))


def row_digest(df: DataFrame) -> Column:
    """A number for a row's content; the sum over rows does not depend on their order."""
    return F.xxhash64(*df.columns)


def table_digest(df: DataFrame) -> DataFrame:
    """rows and digest of a table, whatever the order of its rows."""
    return df.agg(F.count("*").alias("rows"), F.sum(row_digest(df).cast("decimal(38,0)")).alias("digest"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes, sha256 of each file; a file is read whole by one task."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
