"""Resumable work: what is done, which state of a part counts, what is still to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATES = ("UPLOADING", "UPLOADED", "SUBMITTED", "SUCCESS")


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows of `work` whose key is not done."""
    return work.join(done.select(F.col(key).alias("__done")).distinct(), F.col(key) == F.col("__done"), "left_anti")


def rank(state: Column) -> Column:
    """The place of a state; unknown ones rank lowest."""
    return F.coalesce(*(F.when(state == s, k) for k, s in enumerate(STATES, 1)), F.lit(0))


def merged(states: DataFrame, keys: Sequence[str], state: str = "state") -> DataFrame:
    """The highest state of each part; partial maxima go before the shuffle."""
    top = F.max(F.struct(rank(F.col(state)).alias("rank"), F.col(state).alias("state")))
    return states.groupBy(*keys).agg(top.alias("__t")).select(*keys, F.col("__t.state").alias(state), F.col("__t.rank").alias("rank"))


def repaired(states: DataFrame, truth: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States set right by what the service says: FINISH is SUCCESS, FAILURE is taken out, RUNNING waits as SUBMITTED."""
    t = truth.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("status").alias("__status"))
    on = [F.col(k) == F.col(f"__{k}") for k in keys]
    joined = states.join(t, on, "left").where("__status is null or __status <> 'FAILURE'")
    return joined.withColumn("state", F.when(F.col("__status") == "FINISH", "SUCCESS").when(F.col("__status") == "RUNNING", "SUBMITTED").otherwise(F.col("state"))).select(*states.columns)


def pending_jobs(parts: DataFrame, job: str = "job", order: str = "seq") -> DataFrame:
    """Jobs with parts that are no SUCCESS, in their first part's order."""
    return parts.where("state <> 'SUCCESS'").groupBy(job).agg(F.min(order).alias(order), F.count("*").alias("parts")).orderBy(order)
