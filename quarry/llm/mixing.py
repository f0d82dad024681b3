"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact size. A source whose target is at least its size takes every
document once and fills the rest with second copies; any other fills its target with first copies. What is
to be filled is met per source from the counts alone: a like share of every size first, then the largest
sizes that still fit, and the remaining budget by bounded-knapsack dynamic programming over the counts left.
Which documents of a size are taken is fixed by a seeded hash: those up to a threshold (hash, id), which is
found from counts of hash ranges, so that no size, however frequent, is ranked in one task. Deciding about
a row takes its own hash and the plan's row for its source and size. Where rows that share an id lie on the
threshold and only some of them are to be taken, those rows are stored and numbered.

Defined cases. Null text has size 0 and null source is a source of its own, the last. Of rows of one source
with the same size and id that lie on the threshold, the first in the order of the input are taken. Empty sources and empty input have target 0 and take nothing.
Input columns with the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents, stored

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MOST = 2
SEED = 20
#: Words that dynamic programming fits at the end; larger budgets are first filled down to it.
BUDGET = 1 << 15
#: Rows in a range of hashes, on average.
RANGE = 200
#: Plans of up to so many rows are broadcast.
SMALL_PLAN = 200_000


def size_of(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def fill_targets(sizes: list[int], weights: Iterable[int] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> list[float]:
    """Targets of sources in order: share of all sizes by weight, stopped at most times a source's size, the excess shared again."""
    cycle = list(weights)
    w = [cycle[k % len(cycle)] for k in range(len(sizes))]
    budget, open_, out = share * sum(sizes), set(range(len(sizes))), [Fraction(0)] * len(sizes)
    while open_:
        unit = Fraction(budget) / sum(w[k] for k in open_)
        full = {k for k in open_ if unit * w[k] >= most * sizes[k]}
        for k in full or open_:
            out[k] = Fraction(most * sizes[k]) if full else unit * w[k]
        budget -= sum(out[k] for k in full)
        open_ = open_ - full if full else set()
    return [float(x) for x in out]


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, most: int = BUDGET) -> np.ndarray:
    """How many documents of each size to take so that their sum comes nearest the budget. Sizes are positive and distinct."""
    total = int((sizes * counts).sum())
    if budget >= total or not len(sizes):
        return counts.copy()
    take = counts * max(budget, 0) // total
    rest = max(budget, 0) - int((take * sizes).sum())
    for k in np.argsort(-sizes, kind="stable"):  # down to what dynamic programming fits
        if rest <= most:
            break
        more = int(min(counts[k] - take[k], rest // sizes[k]))
        take[k] += more
        rest -= more * int(sizes[k])
    if rest <= 0:
        return take
    while rest < min(most // 4, 4 * int(sizes[counts > 0].min())) and (take > 0).any():  # a budget too small to fit well: give one document back
        k = int(np.flatnonzero(take > 0)[np.argmin(sizes[take > 0])])
        if rest + int(sizes[k]) > most:
            break
        take[k] -= 1
        rest += int(sizes[k])
    return take + _knapsack(sizes, counts - take, rest)


def _knapsack(sizes: np.ndarray, left: np.ndarray, rest: int) -> np.ndarray:
    """Bounded knapsack: sums up to 2 * rest that can be reached, each with the bundle that first reached it."""
    top = 2 * rest
    reached, by = np.zeros(top + 1, bool), np.full(top + 1, -1, np.int64)
    reached[0] = True
    bundles: list[tuple[int, int]] = []
    for k in np.argsort(sizes, kind="stable"):
        n, part = int(min(left[k], top // max(1, int(sizes[k])))), 1
        while n > 0 and not reached[rest]:
            part = min(part, n)
            step = part * int(sizes[k])
            if step > top:
                break
            new = np.flatnonzero(reached[: top + 1 - step] & ~reached[step:]) + step
            reached[new], by[new] = True, len(bundles)
            bundles.append((int(k), part))
            n, part = n - part, part * 2
        if reached[rest]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    more = np.zeros(len(sizes), np.int64)
    while at:
        k, part = bundles[by[at]]
        more[k] += part
        at -= part * int(sizes[k])
    return more


def _hash(id_col: str, seed: int) -> Column:
    """63 random bits of an id."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col)), 1)


def _range(cells: Column) -> Column:
    """The number of a hash's range if there are so many equal ranges."""
    return F.shiftright(F.shiftright(F.col("hash"), 32) * cells, 31)


def plan_mix(sizes: DataFrame, seed: int = SEED) -> DataFrame:
    """A row for each source and size of `sizes` (id, source, size, hash): source_size, target, base copies, and the last (hash, id) that gets one copy more."""
    cells = sizes.groupBy("source", "size").count()
    totals = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("count")).alias("source_size"))

    def targets(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf["key"] = [(s is None, s or "") for s in pdf["source"]]
        pdf = pdf.sort_values("key", ignore_index=True)
        pdf["target"] = fill_targets([int(x) for x in pdf["source_size"]])
        return pdf[["source", "source_size", "target"]]

    kind = sizes.schema["source"].dataType.simpleString()
    aims = totals.groupBy().applyInPandas(targets, f"source {kind}, source_size long, target double")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        base = min(int(target // size), MOST) if size else 0
        pdf = pdf.sort_values("size", ignore_index=True)
        x, n = pdf["size"].to_numpy(np.int64), pdf["count"].to_numpy(np.int64)
        more = np.zeros(len(x), np.int64)
        if base < MOST:
            more[x > 0] = fit_budget(x[x > 0], n[x > 0], round(target) - base * size)
        pdf["base"], pdf["more"] = base, more
        return pdf[["source", "size", "count", "source_size", "target", "base", "more"]]

    both = cells.join(aims.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    plan = both.groupBy("source").applyInPandas(fit, f"source {kind}, size long, count long, source_size long, target double, base int, more long")
    plan = stored(plan.withColumn("cells", F.greatest(F.lit(1), F.floor(F.col("count") / RANGE)).cast("long")), "mix-fit")

    some = plan.where("more > 0 and more < count").select(F.col("source").alias("of"), F.col("size").alias("long"), "more", "cells")
    rows = sizes.join(some, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("long"))).withColumn("range", _range(F.col("cells")))
    ranges = rows.groupBy("of", "long", "range", "more").count()
    so_far = F.expr("sum(count) over (partition by of, long order by range rows unbounded preceding)")
    border = ranges.withColumn("upto", so_far).where("upto >= more and upto - count < more").select(F.col("of").alias("in_source"), F.col("long").alias("in_size"), F.col("range").alias("in_range"), (F.col("more") - F.col("upto") + F.col("count")).alias("n"))
    inside = rows.join(border, F.col("of").eqNullSafe(F.col("in_source")) & (F.col("long") == F.col("in_size")) & (F.col("range") == F.col("in_range")))
    equal = inside.groupBy("of", "long", "n", "hash", "id").count().withColumn("upto", F.expr("sum(count) over (partition by of, long order by hash, id rows unbounded preceding)"))
    last = equal.where("upto >= n and upto - count < n").select("of", "long", F.struct("hash", "id").alias("edge"), (F.col("n") - F.col("upto") + F.col("count")).alias("need"), F.col("count").alias("among"))
    full = F.struct(F.lit((1 << 63) - 1).alias("hash"), F.lit(None).cast(sizes.schema["id"].dataType).alias("id"))
    none = F.struct(F.lit(-1).cast("long").alias("hash"), F.lit(None).cast(sizes.schema["id"].dataType).alias("id"))
    joined = plan.join(last, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("long")), "left")
    edge = F.when(F.col("more") == 0, none).when(F.col("more") >= F.col("count"), full).otherwise(F.col("edge"))
    some_of = F.when(F.col("need") < F.col("among"), F.col("need"))  # null: all rows on the threshold
    return stored(joined.select("source", "size", "source_size", "target", "base", edge.alias("edge"), some_of.alias("need")), "mix-plan")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """`df`, or its columns `keep`, with size, source_size, target and int copies (0, 1 or 2)."""
    sizes = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size")).withColumn("hash", _hash("id", seed))
    sizes = stored(sizes, "mix-sizes")
    plan = plan_mix(sizes, seed).select(F.col("source").alias("__source"), F.col("size").alias("__size"), "source_size", "target", F.col("base").alias("__base"), F.col("edge").alias("__edge"), F.col("need").alias("__need"))
    names = [c for c in (keep or df.columns) if c not in ("size", "source_size", "target", "copies")]
    if keep and set(keep) <= {id_col, source_col}:
        rows = sizes.withColumn("__hash", F.col("hash")).select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "__hash")
    else:
        rows = df.select(*names, *(c for c in {id_col, source_col} if c not in names), size_of(F.col(text_col)).alias("size")).withColumn("__hash", _hash(id_col, seed))
    split = not plan.where("__need is not null").isEmpty()
    if plan.count() <= SMALL_PLAN:
        plan = F.broadcast(plan)
    rows = rows.join(plan, F.col(source_col).eqNullSafe(F.col("__source")) & (F.col("size") == F.col("__size")))
    own = F.struct(F.col("__hash").alias("hash"), F.col(id_col).alias("id"))
    chosen = lambda some, extra: some.select(*names, "size", "source_size", "target", (F.col("__base") + extra.cast("int")).alias("copies"))
    if not split:
        return chosen(rows, own <= F.col("__edge"))
    on = F.col("__need").isNotNull() & (own == F.col("__edge"))
    return chosen(rows.where(~on), own <= F.col("__edge")).unionByName(chosen(_numbered(rows.where(on)), F.col("__number") <= F.col("__need")))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows of each __source and __size with __number, from 1 in the order of the input. They are stored; each task numbers its own, behind those of the tasks before."""
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "mix-ties").withColumn("__task", F.shiftright("__row", 33))
    counts = rows.groupBy("__source", "__size", "__task").count()
    before = counts.withColumn("__before", F.expr("sum(count) over (partition by __source, __size order by __task rows unbounded preceding) - count"))
    before = F.broadcast(before.select(F.col("__source").alias("__s"), F.col("__size").alias("__z"), F.col("__task").alias("__t"), "__before"))  # a row for each task of each split size
    inside = rows.withColumn("__in", F.expr("row_number() over (partition by __source, __size, __task order by __row)"))
    both = inside.join(before, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__size") == F.col("__z")) & (F.col("__task") == F.col("__t")))
    return both.withColumn("__number", F.col("__in") + F.col("__before"))


def mixed(df: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of `df`, each as often as it is taken."""
    taken = mix(df, **options)
    return taken.withColumn("__copy", F.explode(F.expr("array_repeat(0, copies)"))).select(*df.columns)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(documents(spark, sf_dir), keep=["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


QUERIES = {"op5_mixing": op5_mixing}
SQL: dict[str, str] = {}
