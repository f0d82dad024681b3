"""What the query modules share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table that is read in fewer tasks than there are cores, dealt out to all of them: for work on texts, which takes far longer
    than moving them. Tables of many files or splits stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def register(queries: dict, oracles: dict[str, str]):
    """A decorator that adds a query under its name, with its SQL if there is any."""

    def query(sql: str | None = None):
        def add(f):
            queries[f.__name__] = f
            if sql:
                oracles[f.__name__] = sql
            return f

        return add

    return query
