"""Exact deduplication: two passes of Bloom filtering, so that only rows that may be repeated shuffle.

Pass 1 hashes every text to one bit in each half of a bit table and finds the bits that two or more rows
hit. Pass 2 sends a row through a shuffle only if both of its bits were hit more than once; any other row
is alone in its group and passes straight through. Bits collide, so a few unique rows shuffle too; no
repeated row can escape, since equal texts hit equal bits.

A bit table has 16 bits a row and at most `max_bits`, so that what is broadcast has at most max_bits / 64 rows
of two longs. Where rows need more, hashes are cut into slices with a table each, one after the other; filters
stay as sharp then, whatever the input. Pass 1 itself shuffles two numbers for each row, no hash and no text.

Defined cases. Null text counts as empty. Equal texts with equal ids: one row of them stays, and which one
is fixed by the rows' order in the input files. Null ids sort below all others. Empty input: empty output.
Columns of the input that are named like a result column are replaced by it. Columns without an order (maps)
are kept and take no part in ties.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import documents, stored

MAX_BITS = 1 << 27
BITS_PER_ROW = 16


def normalised(text: Column) -> Column:
    """Lower-cases A-Z alone; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def text_sha256(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def table_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """A power of two, 16 bits a row where max_bits allows."""
    return max(1 << 10, min(max_bits, 1 << max(1, BITS_PER_ROW * rows - 1).bit_length()))


def _probes(key: Column, bits: int) -> list[Column]:
    half = bits // 2
    return [F.pmod(F.xxhash64(key), F.lit(half)), F.pmod(F.xxhash64(key, F.lit(1)), F.lit(half)) + half]


def repeated_bits(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Pass 1: (word, mask) of the bits that more than one row hits, 64 bits a word."""
    hits = keys.select(F.explode(F.array(*_probes(F.col(key), bits))).alias("bit")).groupBy("bit").count().where("count > 1")
    return hits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("mask"))


def maybe_repeated(df: DataFrame, key: str, words: DataFrame, bits: int) -> DataFrame:
    """Pass 2: `df` with boolean __maybe. `words` has at most bits / 64 rows, a fixed bound."""
    flag = F.lit(True)
    for k, bit in enumerate(_probes(F.col(key), bits)):
        own = words.select(F.col("word").alias(f"__word{k}"), F.col("mask").alias(f"__mask{k}"))
        df = df.withColumn(f"__bit{k}", bit).withColumn(f"__at{k}", F.shiftright(f"__bit{k}", 6))
        df = df.join(F.broadcast(own), F.col(f"__at{k}") == F.col(f"__word{k}"), "left")
        flag = flag & (F.expr(f"coalesce(shiftright(__mask{k}, int(__bit{k} & 63)) & 1L, 0L)") == 1)
    return df.withColumn("__maybe", flag).drop(*(f"__{x}{k}" for x in ("word", "mask", "bit", "at") for k in (0, 1)))


def flagged_keys(keys: DataFrame, key: str, rows: int, max_bits: int) -> DataFrame:
    """Both passes over stored keys: `keys` with boolean __maybe, false only for rows that are alone."""
    slices = max(1, -(-BITS_PER_ROW * rows // max_bits))
    bits = table_bits(-(-rows // slices), max_bits)
    if slices > 1:
        keys = stored(keys.withColumn("__slice", F.pmod(F.xxhash64(F.col(key), F.lit(2)), F.lit(slices)).cast("int")), "dedup-slices", "__slice")
    found = []
    for k in range(slices):
        own = keys.where(F.col("__slice") == k).drop("__slice") if slices > 1 else keys
        found.append(maybe_repeated(own, key, stored(repeated_bits(own, key, bits), "dedup-bits"), bits))
    return reduce(DataFrame.unionByName, found)


def mark_copies(keys: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Stored `keys` (id, sha, row and any others) with keep, size and kept: the largest id and the number of rows of equal sha, and whether this row stays.

    Groups above a thousandth of the rows (a thousand at most) are broadcast; the others are joined by hash.
    """
    rows = keys.count()
    flagged = flagged_keys(keys, "sha", rows, max_bits)
    maybe, alone = flagged.where("__maybe").drop("__maybe"), flagged.where("not __maybe").drop("__maybe")
    groups = maybe.groupBy("sha").agg(F.max(F.struct("id", "row")).alias("top"), F.count("*").alias("size")).where("size > 1")
    groups = stored(groups.select("sha", F.col("top.id").alias("keep"), F.col("top.row").alias("keep_row"), "size"), "dedup-groups")
    heavy = F.broadcast(groups.where(F.col("size") > max(1000, rows // 1000)))
    light = groups.where(F.col("size") <= max(1000, rows // 1000))
    hot = maybe.join(heavy, "sha")
    rest = maybe.join(heavy.select("sha"), "sha", "left_anti").join(light, "sha", "left")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("keep", keys.schema["id"].dataType), ("keep_row", "long"), ("size", "long"))]
    found = hot.unionByName(rest).unionByName(alone.select("*", *none))
    own = F.col("size").isNull()
    return found.select(*keys.columns, F.when(own, F.col("id")).otherwise(F.col("keep")).alias("keep"), F.coalesce("size", F.lit(1)).alias("size"), (own | (F.col("row") == F.col("keep_row"))).alias("kept"))


def find_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row for each row of `df`: its id, keep_id, group_size, kept, text_sha256.

    keep_id is the largest id among equal texts. Texts are read once; what is grouped are ids and hashes.
    """
    keys = stored(df.select(F.col(id_col).alias("id"), text_sha256(F.col(text_col)).alias("sha"), F.monotonically_increasing_id().alias("row")), "dedup-keys")
    found = mark_copies(keys, max_bits)
    return found.select(F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))


def _ordered(kind: T.DataType) -> bool:
    """Whether values of this type have an order."""
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind)
    return _ordered(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of `df` that stay, with all their columns: of equal texts the one with the largest id, then the largest remaining columns.

    Hashes alone go through both passes and are counted; rows of hashes that are repeated indeed (and the few that share their bits) shuffle.
    """
    keys = stored(df.select(text_sha256(F.col(text_col)).alias("sha")), "dedup-hashes")
    repeated = flagged_keys(keys, "sha", keys.count(), max_bits).where("__maybe").groupBy("sha").count().where("count > 1")
    repeated = stored(repeated.select("sha"), "dedup-repeated")
    bits = table_bits(repeated.count(), max_bits)
    hit = repeated.select(F.explode(F.array(*_probes(F.col("sha"), bits))).alias("bit"))
    words = hit.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("mask"))
    flagged = maybe_repeated(df.withColumn("__sha", text_sha256(F.col(text_col))), "__sha", stored(words, "dedup-bits"), bits)
    order = [id_col, *(f.name for f in df.schema if f.name != id_col and _ordered(f.dataType))]
    kept = flagged.where("__maybe").groupBy("__sha").agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__top")).select("__top.*")
    return flagged.where("not __maybe").select(*df.columns).unionByName(kept)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(documents(spark, sf_dir))


ORACLE = """
with d as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents)
select doc_id, max(doc_id) over (partition by text_sha256) as keep_id, count(*) over (partition by text_sha256) as group_size,
       doc_id = max(doc_id) over (partition by text_sha256) as kept, text_sha256
from d
"""

QUERIES = {"op6_exact_dedup": op6_exact_dedup}
SQL = {"op6_exact_dedup": ORACLE}
