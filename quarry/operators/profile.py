"""Data profiling: empty rates, fill rates, extremes, code and text pairs, residue."""

from __future__ import annotations

import json
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import first_n


def is_blank(c: Column) -> Column:
    """Null, or empty after stripping."""
    return F.coalesce(F.trim(c.cast("string")) == "", F.lit(True))


def empty_rates(df: DataFrame, columns: Iterable[str], least: int = 100, top: int = 20) -> DataFrame:
    """field, total, empty, rate of the emptiest fields with `least` values or more. Every field is counted in one pass over the rows."""
    columns = list(columns)
    sums = df.agg(F.count("*").alias("n"), *(F.count_if(is_blank(F.col(c))).alias(f"e{k}") for k, c in enumerate(columns)))
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col("n").alias("total"), F.col(f"e{k}").alias("empty")) for k, c in enumerate(columns)))
    rates = sums.select(F.inline(pairs)).withColumn("rate", F.round(F.col("empty") / F.col("total"), 6))
    return rates.where(F.col("total") >= least).orderBy(F.desc("rate"), F.desc("total"), "field").limit(top)


def fill_rates(df: DataFrame, columns: Iterable[str], by: Iterable[str] = ()) -> DataFrame:
    """The share of rows with a filled value, for each column."""
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *(F.round(F.avg(F.when(is_blank(F.col(c)), 0.0).otherwise(1.0)), 6).alias(f"fill_{c}") for c in columns))


def longest(df: DataFrame, column: str, seq: str) -> DataFrame:
    """The longest value's row: its sequence number and length; the first of equals."""
    size = F.length(F.coalesce(F.col(column), F.lit("")))
    best = F.min(F.struct((-size).alias("k"), F.col(seq).alias("seq")))
    return df.agg(best.alias("b")).select(F.lit(column).alias("field"), F.col("b.seq").alias("seq"), (-F.col("b.k")).cast("long").alias("length"))


def code_text_pairs(df: DataFrame, code: str, text: str, most: int = 5) -> DataFrame:
    """For each code the number of texts it has and, in order, up to `most` of them: a report's examples.

    Texts are ranked with a limit before they are brought together, so that no task holds all texts of one code.
    """
    pairs = df.where(~is_blank(F.col(code))).groupBy(code, text).count()
    totals = pairs.groupBy(code).agg(F.count("*").alias("texts"), F.sum("count").alias("rows"))
    ranked = first_n(pairs.where(F.col(text).isNotNull()), [code], [text], most)
    examples = ranked.groupBy(code).agg(F.array_join(F.array_sort(F.collect_list(text)), ";").alias("examples"))
    return totals.join(examples, code, "left").select(code, "texts", "rows", F.coalesce("examples", F.lit("")).alias("examples"))


#: Fixed kinds of residue and the patterns that show them.
RESIDUE = {"entity": r"&[a-zA-Z]+;|&#[0-9]+;", "tag": r"</?[a-zA-Z][^>]*>", "tab": r"\t", "del": r"\x7f", "control": r"[\x00-\x08\x0b-\x1f]"}


def residue(df: DataFrame, column: str) -> DataFrame:
    """kind, rows, hits: what cleaning would still find."""
    counts = df.agg(*(x for k, p in RESIDUE.items() for x in (F.sum(F.regexp_count(F.col(column), F.lit(p))).alias(f"h_{k}"), F.count_if(F.regexp_like(F.col(column), F.lit(p))).alias(f"r_{k}"))))
    pairs = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"r_{k}").alias("rows"), F.coalesce(F.col(f"h_{k}"), F.lit(0)).cast("long").alias("hits")) for k in RESIDUE))
    return counts.select(F.inline(pairs))


def residue_items(df: DataFrame, column: str, kind: str, top: int = 25) -> DataFrame:
    """The most frequent pieces of one kind of residue."""
    found = df.select(F.explode(F.regexp_extract_all(F.col(column), F.lit(f"({RESIDUE[kind]})"), F.lit(1))).alias("item"))
    return found.groupBy("item").count().orderBy(F.desc("count"), "item").limit(top)


def json_paths(df: DataFrame, column: str) -> DataFrame:
    """path, total, empty over JSON texts of unknown shape; list elements share their list's path. Counts are summed in each task first."""

    def walk(node, path, out):
        if isinstance(node, dict):
            for k, v in node.items():
                walk(v, f"{path}.{k}" if path else k, out)
        elif isinstance(node, list) and node:
            for v in node:
                walk(v, path, out)
        else:
            n = out.setdefault(path, [0, 0])
            n[0] += 1
            n[1] += node in (None, "", [])

    def run(batches):
        out: dict[str, list[int]] = {}
        for pdf in batches:
            for text in pdf[column].dropna():
                try:
                    walk(json.loads(text), "", out)
                except ValueError:
                    continue
        yield pd.DataFrame([(p, *n) for p, n in out.items()], columns=["path", "total", "empty"])

    return df.select(column).mapInPandas(run, "path string, total long, empty long").groupBy("path").agg(F.sum("total").alias("total"), F.sum("empty").alias("empty"))
