"""Tables that cut lineage, kept in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a batch that goes to a Python worker: what JVM and worker hold of it at once, several times over.
BATCH_BYTES = 4 << 20
_LOCAL: dict[str, str] = {}


def shared_base(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only where it is unset a local one is chosen, and only if all of Spark runs on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="quarry-")
    return _LOCAL[context.applicationId]


_SLOT: list = [None, None]


def worker_keeps(key, make):
    """What `make` gives, kept in this Python worker from task to task until another key is asked for: a worker holds one such thing."""
    if _SLOT[0] != key:
        _SLOT[:] = [None, None]
        _SLOT[:] = [key, make()]
    return _SLOT[1]


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow, with batches bounded by bytes besides rows, since texts can be long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. It is removed when the driver's file system is closed."""
    path = f"{shared_base(spark)}/quarry/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame, name: str, folders: str = "") -> DataFrame:
    """`df` written as a Parquet table in the shared folder and read again: a lost executor loses nothing of it. A column `folders` has a folder for each of its values."""
    path = scratch(df.sparkSession, name)
    (df.write.partitionBy(folders) if folders else df.write).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.quarry_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing will read any more: what was made of them is stored itself."""
    for table in tables:
        remove(table.sparkSession, table.quarry_path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def weighted_join(rows: DataFrame, key: str, table: DataFrame, weight: str, limit: int) -> DataFrame:
    """Inner join by a key that is unique in `table`, whose `weight` is the key's number of rows.

    Keys beyond the limit are broadcast: there are fewer of them than the rows divided by the limit. So no task gets the rows of
    one heavy key, and the others are joined by hash. Callers take a thousandth of the rows as limit, or a thousand.
    """
    own = table.withColumnRenamed(key, "__key")
    heavy, light = own.where(F.col(weight) > limit), own.where(F.col(weight) <= limit)
    on = F.col(key) == F.col("__key")
    hot = rows.join(F.broadcast(heavy), on).drop("__key")
    rest = rows.join(F.broadcast(heavy.select("__key")), on, "left_anti").join(light, on).drop("__key")
    return hot.unionByName(rest)


def salted_join(rows: DataFrame, key: str, table: DataFrame, limit: int) -> DataFrame:
    """Inner join by a key that is unique in `table`. A key with more than `limit` of the rows is dealt to several tasks, each with a copy
    of the table's row. What is broadcast are such keys and their numbers of tasks: fewer than the rows divided by the limit."""
    heavy = rows.groupBy(key).count().where(F.col("count") > limit).select(F.col(key).alias("__key"), F.ceil(F.col("count") / limit).cast("int").alias("__parts"))
    on = F.col(key) == F.col("__key")
    ours = rows.join(F.broadcast(heavy), on, "left").withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), F.coalesce("__parts", F.lit(1))).cast("int")).drop("__key", "__parts")
    theirs = table.join(F.broadcast(heavy), on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__key", "__parts")
    return ours.join(theirs, [key, "__salt"]).drop("__salt")


def heavy_limit(rows: int) -> int:
    return max(1000, rows // 1000)
