"""Scoring of answers: exact match, token F1, summaries and comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bag_f1, scoring_normal, tokens

REFUSALS = ("无法回答", "未找到", "没有相关信息", "不清楚", "抱歉")


def score_answers(gold: DataFrame, predictions: DataFrame, key: str = "test_id", ascii_only: bool = False) -> DataFrame:
    """gold (key, expected_answer, ...) with answer, em, f1, answered and refused; without a prediction an answer is empty."""
    joined = gold.join(predictions.select(F.col(key).alias("__key"), "answer"), F.col(key) == F.col("__key"), "left")
    joined = joined.withColumn("__p", scoring_normal("answer", ascii_only)).withColumn("__g", scoring_normal("expected_answer", ascii_only))
    refused = F.coalesce(F.regexp_like("answer", F.lit("|".join(REFUSALS))), F.lit(False))
    answered = F.col("__key").isNotNull() & (F.trim(F.coalesce("answer", F.lit(""))) != "")
    scored = joined.withColumn("em", (F.col("__p") == F.col("__g")).cast("int")).withColumn("f1", bag_f1(tokens("__p"), tokens("__g"))).withColumn("answered", answered).withColumn("refused", refused)
    return scored.drop("__key", "__p", "__g")


def last_predictions(lines: DataFrame, key: str = "test_id", order: str = "line_no") -> DataFrame:
    """One answer for each id: the last one counts."""
    return lines.groupBy(key).agg(F.max_by(F.coalesce("answer", F.lit("")), order).alias("answer"))


def summarise(scored: DataFrame, dims: Sequence[str] = ("dataset", "answer_type"), digits: int = 6) -> DataFrame:
    """n, answered, refused, em, f1 overall, by each dimension and by both, in one aggregation over grouping sets; `level` names the set."""
    a, b = dims
    sets = scored.groupingSets([[], [F.col(a)], [F.col(b)], [F.col(a), F.col(b)]], F.col(a), F.col(b))
    out = sets.agg(
        F.count("*").alias("n"), F.count_if("answered").alias("answered"), F.count_if("refused").alias("refused"),
        F.round(F.avg("em"), digits).alias("em"), F.round(F.avg("f1"), digits).alias("f1"), F.grouping(a).alias("__a"), F.grouping(b).alias("__b"),
    )
    level = F.when((F.col("__a") == 1) & (F.col("__b") == 1), "all").when(F.col("__b") == 1, a).when(F.col("__a") == 1, b).otherwise(f"{a}+{b}")
    return out.withColumn("level", level).drop("__a", "__b")


def percentiles(df: DataFrame, by: Sequence[str], value: str, points: Sequence[int] = (25, 50, 75, 90, 99)) -> DataFrame:
    """Percentiles by nearest rank: of n values the one at place ceil(p n / 100)."""
    exact = lambda p: F.expr(f"percentile_disc({p / 100}) within group (order by {value})").cast(df.schema[value].dataType)
    return df.groupBy(*by).agg(F.count("*").alias("n"), *(exact(p).alias(f"p{p}") for p in points))


def distribution(df: DataFrame, group: Column, value: str) -> DataFrame:
    """value, a, b, diff: counts where `group` is true and false, the largest differences first."""
    counts = df.groupBy(value).agg(F.count_if(group).alias("a"), F.count_if(~group).alias("b"))
    return counts.withColumn("diff", F.col("a") - F.col("b")).orderBy(F.desc(F.abs("diff")), value)


def alignment(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key and side (both, left, right) of the distinct keys of two tables."""
    a, b = left.select(F.col(key).alias("__a")).distinct(), right.select(F.col(key).alias("__b")).distinct()
    joined = a.join(b, F.col("__a") == F.col("__b"), "full_outer")
    return joined.select(F.coalesce("__a", "__b").alias(key), F.when(F.col("__b").isNull(), "left").when(F.col("__a").isNull(), "right").otherwise("both").alias("side"))


def both_empty(scanned: Column, left_only: Column, right_only: Column, both: Column) -> Column:
    """How many of the scanned blocks neither run kept; null if the counts can't be right."""
    rest = scanned - left_only - right_only - both
    return F.when(scanned.isNotNull() & (rest >= 0), rest)
