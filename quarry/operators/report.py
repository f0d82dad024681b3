"""Reports: small frames as Markdown and JSON, expectations as counts, comparisons of two extraction runs."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dedup, score


def _cell(value: object) -> str:
    return "" if value is None else str(value).replace("|", "\\|").replace("\n", " ")


def markdown(df: DataFrame, most: int = 100) -> str:
    """A report's table; a report has few rows, and says how many it shows."""
    rows = df.limit(most + 1).collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines += ["| " + " | ".join(map(_cell, r)) + " |" for r in rows[:most]]
    return "\n".join(lines + ([f"(the first {most} rows)"] if len(rows) > most else []))


def sections(parts: dict[str, DataFrame | str]) -> str:
    """A Markdown text with a heading and a table or text for each part."""
    return "\n\n".join(f"## {title}\n\n{part if isinstance(part, str) else markdown(part)}" for title, part in parts.items()) + "\n"


def as_json(parts: dict[str, DataFrame], most: int = 1000) -> str:
    """A report's tables as JSON, whole: one of more than `most` rows is an error, since a report is read by the driver."""
    found = {}
    for title, df in parts.items():
        rows = df.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"more than {most} rows in {title}: write them as a table")
        found[title] = [r.asDict(recursive=True) for r in rows]
    return json.dumps(found, ensure_ascii=False, default=str)


def expected_nodes(specs: dict[str, tuple[DataFrame, str] | int]) -> DataFrame:
    """type, n: a given number, or the distinct ids of a column, blanks left out. Each spec is one aggregate of its table."""
    spark = next(s[0].sparkSession for s in specs.values() if not isinstance(s, int))
    given = [(k, n) for k, n in specs.items() if isinstance(n, int)]
    own = [d.select(F.trim(F.col(c).cast("string")).alias("id")).where("id <> ''").agg(F.count_distinct("id").alias("n")).select(F.lit(k).alias("type"), "n") for k, (d, c) in ((k, s) for k, s in specs.items() if not isinstance(s, int))]
    return reduce(DataFrame.unionByName, [*([spark.createDataFrame(given, "type string, n long")] if given else []), *own])


def expected_edges(specs: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """type, n: the distinct pairs of two columns, pairs with a blank left out."""
    parts = []
    for k, (d, s, o) in specs.items():
        pairs = d.select(F.trim(F.col(s).cast("string")).alias("s"), F.trim(F.col(o).cast("string")).alias("o")).where("s <> '' and o <> ''").distinct()
        parts.append(pairs.agg(F.count("*").alias("n")).select(F.lit(k).alias("type"), "n"))
    return reduce(DataFrame.unionByName, parts)


def compare_runs(a: DataFrame, b: DataFrame, key: str = "chunk_id", value: str = "predicate", statement: str = "statement", seq: str = "seq") -> dict[str, DataFrame]:
    """Two extraction runs side by side: blocks, statements matched as bags, statements a block, and the distribution of values."""
    met = dedup.bag_match(a, b, [key, statement], seq)
    left, right = F.col("left_seq").isNotNull(), F.col("right_seq").isNotNull()
    both = a.select(value).withColumn("__a", F.lit(True)).unionByName(b.select(value).withColumn("__a", F.lit(False)))
    per_block = lambda df, run: df.groupBy(key).agg(F.count("*").alias("n")).withColumn("run", F.lit(run))
    return {
        "blocks": score.alignment(a, b, key).groupBy("side").agg(F.count("*").alias("blocks")),
        "statements": met.agg(F.count_if(left & right).alias("matched"), F.count_if(left & ~right).alias("only_a"), F.count_if(~left & right).alias("only_b")),
        "per_block": score.percentiles(per_block(a, "a").unionByName(per_block(b, "b")), ["run"], "n"),
        "values": score.distribution(both, F.col("__a"), value),
    }


def parameters_match(state: dict, wanted: dict, keys: Sequence[str]) -> bool:
    """Whether a kept sample was drawn with the same parameters."""
    return all(state.get(k) == wanted.get(k) for k in keys)
