"""Sharding by a permutation-filled lookup table.

Each shard has a preference order over the slots of a prime-sized table: offset, offset + skip, ... modulo
the size, both numbers taken from a hash of the shard's name. Shards take turns claiming their next free
slot until none is left, so each owns as many slots as any other, give or take one. A key's slot is its
hash modulo the size; the table (`slots` rows at most, a parameter and not a function of the data) is
broadcast, which makes placement one lookup a row without any shuffle. Taking a shard out moves its own
keys and few others.

Defined cases. A null key counts as the empty string. Equal keys share a shard. Empty input: empty output.
Input columns named slot or shard are replaced.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents

SLOTS = 10007
SHARDS = 64


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number that owns each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct and at least one")
    if not is_prime(slots) or slots < len(shards):
        raise ValueError("slots must be a prime number, no smaller than the number of shards")
    marks = [int.from_bytes(hashlib.md5(name.encode()).digest(), "big") for name in shards]
    place = [m % slots for m in marks]
    skip = [(m >> 64) % (slots - 1) + 1 for m in marks]
    owner, left = [-1] * slots, slots
    while left:
        for shard in range(len(shards)):
            while owner[place[shard]] >= 0:
                place[shard] = (place[shard] + skip[shard]) % slots
            owner[place[shard]] = shard
            left -= 1
            if not left:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def assign_shards(df: DataFrame, key: str = "doc_id", shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """`df` with int columns slot and shard."""
    names = shards if shards is not None else shard_names()
    table = df.sparkSession.range(1).select(F.posexplode(F.from_json(F.lit(json.dumps(fill_table(names, slots))), "array<int>")).alias("__slot", "__shard"))
    placed = df.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), slots))
    return placed.join(F.broadcast(table), F.col("slot") == F.col("__slot")).withColumnRenamed("__shard", "shard").drop("__slot")


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{k:03d}" for k in range(n)]


def write_shards(df: DataFrame, path: str, key: str = "doc_id", shards: list[str] | None = None, slots: int = SLOTS, max_records: int = 1_000_000) -> None:
    """Parquet folders shard=N under `path`. Rows move to tasks by slot, so a shard's rows are spread over tasks, and files end at `max_records` rows."""
    assign_shards(df, key, shards, slots).repartition("slot").drop("slot").write.option("maxRecordsPerFile", max_records).partitionBy("shard").parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir).select("doc_id"))


def oracle() -> str:
    table = ",".join(map(str, fill_table(shard_names())))
    return f"""
with t as (select unnest([{table}]) as shard, unnest(range({SLOTS})) as slot),
d as (select doc_id, (('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint % {SLOTS})::int as slot from documents)
select d.doc_id, d.slot, t.shard::int as shard from d join t on d.slot = t.slot
"""


QUERIES = {"op10_sharding": op10_sharding}
SQL = {"op10_sharding": oracle()}
