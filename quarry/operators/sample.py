"""Samples by seeded hashes: the same rows on every run and any partitioning, with quotas for strata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import first_n


def seeded(key: Column | str, seed: int) -> Column:
    """An order that any engine with md5 can repeat."""
    return F.md5(F.concat((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(f"|{seed}")))


def fit_quotas(sizes: dict, limit: int) -> dict:
    """Shares of `limit` in proportion to the strata's sizes, one at least while that is possible, no more than there are; they add up to the limit if there are enough rows."""
    total = sum(sizes.values())
    if total <= limit:
        return dict(sizes)
    quota = {k: min(n, max(1, limit * n // total)) for k, n in sizes.items()}
    order = sorted(sizes, key=lambda k: (-(limit * sizes[k] % total), -sizes[k], str(k)))
    while sum(quota.values()) != limit:
        gap = limit - sum(quota.values())
        room = [k for k in (order if gap > 0 else reversed(order)) if (quota[k] < sizes[k] if gap > 0 else quota[k] > 1)] or [k for k in reversed(order) if quota[k] > 0]
        for k in room[: abs(gap)]:
            quota[k] += 1 if gap > 0 else -1
    return quota


def stratified(df: DataFrame, strata: Sequence[str], key: str, n: int, seed: int) -> DataFrame:
    """n rows of each stratum."""
    return first_n(df, list(strata), [seeded(key, seed), F.col(key)], n)


def with_quotas(df: DataFrame, stratum: str, key: str, limit: int, seed: int) -> DataFrame:
    """`limit` rows in proportion to the strata. The driver sees a count for each stratum; the strata are few by the operator's contract."""
    quotas = fit_quotas(dict(df.groupBy(stratum).count().collect()), limit)
    if not quotas:
        return df.limit(0)
    quota = F.coalesce(*(F.when(F.col(stratum).eqNullSafe(F.lit(k)), F.lit(n)) for k, n in quotas.items()))
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(stratum).orderBy(seeded(key, seed), key)))
    return ranked.where(F.col("__r") <= F.greatest(F.lit(0), quota)).where(F.col("__r") <= max(quotas.values())).drop("__r")


def best_tiers(df: DataFrame, stratum: str, score: Column, key: str, n: int, seed: int) -> DataFrame:
    """n rows of each stratum, those of the highest score first, by seed within a score."""
    return first_n(df, [stratum], [score.desc(), seeded(key, seed), F.col(key)], n)


def round_robin(df: DataFrame, kind: str, category: str, key: str, quota: int, seed: int, title: str | None = None, most_per_title: int = 2) -> DataFrame:
    """`quota` rows of each kind, taken from its categories in turn; a title is used at most so often. Gives `turn` too."""
    if title:
        df = first_n(df, [title], [seeded(key, seed), F.col(key)], most_per_title)
    ranked = df.withColumn("turn", F.row_number().over(Window.partitionBy(kind, category).orderBy(seeded(key, seed), key))).where(F.col("turn") <= quota)
    return first_n(ranked, [kind], ["turn", category], quota)
