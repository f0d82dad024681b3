"""Approximate nearest neighbours by learned partitions.

A bounded sample's neighbour graph is cut into balanced parts with few edges between them. A small
classifier learns which part a vector's neighbours lie in; it gives every vector of the table its most
probable part and sends a query to the several most probable ones: as many as hold the probability that,
on held-out vectors of the sample, was enough to reach 96 % of their neighbours. Vectors without structure
thus cost more visits, not recall. What a query meets there is ranked by exact distance in double precision
on the original vectors.

Every row is indexed. The sample (10,000 vectors, those of smallest hash) is a parameter and the only bound: a part
has 250 rows, or as many more as let a twentieth of the sample's rows be parts. Of vectors that are equal in every
component only those of the k + 1 smallest ids, and k rows of each id, can be among k nearest with ties to the
smaller id, so no more of them are compared; this drops no result, and only vectors of a hash that more than k rows
have are brought together for it. Parts are compared in tiles of candidates and queries, so that a large part is
many tasks, and a tile gives the k nearest of each query.

Defined cases. Vectors that are null, empty, zero, hold null or non-finite components, or have not the most
common length take no part, nor do rows without id. Ties go to the smaller id. Rows that share an id are
each a candidate, and no candidate of a query with that id. Fewer candidates than k: all that are found.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import map_arrow, stored

SAMPLE = 10_000
PART_ROWS = 250
#: Rows of the sample for each part.
LEARNT_FROM = 20
#: Hashes of crowded vectors that are broadcast; more are joined by hash.
CROWDED = 200_000
#: Share of a held-out sample's neighbours that the parts visited must hold; parts that a query visits at least.
RECALL, PROBES = 0.96, 2
#: Rows on either side of a tile, on average.
TILE = 4096


def neighbour_graph(x: np.ndarray, k: int = 10) -> np.ndarray:
    """The k nearest other rows of each row."""
    k = min(k, len(x) - 1)
    out, norm = np.empty((len(x), k), np.int64), (x * x).sum(1)
    for at in range(0, len(x), 1024):
        d = norm - 2 * x[at : at + 1024] @ x.T
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        out[at : at + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """A part for each row: halves by the main direction to begin with, then moves to the part where most neighbours are, as far as sizes allow."""
    part, groups = np.zeros(len(x), np.int64), [(np.arange(len(x)), parts, 0)]
    while groups:
        rows, n, first = groups.pop()
        if n == 1:
            part[rows] = first
            continue
        own = x[rows] - x[rows].mean(0)
        axis = np.random.default_rng(first).normal(size=x.shape[1])
        for _ in range(8):
            axis = own.T @ (own @ axis)
            axis /= max(np.linalg.norm(axis), 1e-30)
        order = np.argsort(own @ axis, kind="stable")
        cut = len(rows) * (n // 2) // n
        groups += [(rows[order[:cut]], n // 2, first), (rows[order[cut:]], n - n // 2, first + n // 2)]
    both = np.concatenate([np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()]), np.concatenate([graph.ravel(), np.repeat(np.arange(len(x)), graph.shape[1])])
    most, least = slack * len(x) / parts + 1, len(x) / parts / slack - 1
    for _ in range(rounds):
        votes = np.zeros((len(x), parts), np.float32)
        np.add.at(votes, (both[0], part[both[1]]), 1)
        want, rows = votes.argmax(1), np.arange(len(x))
        gain = votes[rows, want] - votes[rows, part]
        size, moved = np.bincount(part, minlength=parts), 0
        for r in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            if size[want[r]] < most and size[part[r]] > least:
                size[part[r]] -= 1
                size[want[r]] += 1
                part[r] = want[r]
                moved += 1
        if moved < len(x) // 1000 + 1:
            break
    return part


@dataclass
class Router:
    """A network of one hidden layer: probabilities of parts for vectors."""

    mean: np.ndarray
    scale: float
    weights: list[np.ndarray]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        z = np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit_router(x: np.ndarray, graph: np.ndarray, part: np.ndarray, parts: int, hidden: int = 128, epochs: int = 25) -> Router:
    """Learns the share of parts among a vector and its neighbours, by Adam on small batches."""
    rng = np.random.default_rng(5)
    goal = np.zeros((len(x), parts), np.float32)
    np.add.at(goal, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
    goal[np.arange(len(x)), part] += 2
    goal /= goal.sum(1, keepdims=True)
    mean, scale = x.mean(0), float(x.std()) or 1.0
    z = ((x - mean) / scale).astype(np.float32)
    w = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, (hidden, parts)), np.zeros(parts)]
    w = [a.astype(np.float32) for a in w]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            h = np.maximum(z[rows] @ w[0] + w[1], 0)
            p = h @ w[2] + w[3]
            p = np.exp(p - p.max(1, keepdims=True))
            d = (p / p.sum(1, keepdims=True) - goal[rows]) / len(rows)
            dh = (d @ w[2].T) * (h > 0)
            step += 1
            for k, g in enumerate((z[rows].T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Router(mean, scale, [a.astype(np.float64) for a in w])


def nearest(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's row, id, distance) of each query's k nearest in x, with ties to the smaller id and without rows of its own id."""
    rows, found, score = [], [], []
    norm, k2 = (x * x).sum(1), min(len(x), k)
    for at in range(0, len(queries), 256):
        q = queries[at : at + 256]
        own = (q * q).sum(1)[:, None]
        d = norm - 2 * q @ x.T + own
        d[query_ids[at : at + 256, None] == ids] = np.inf
        edge = np.partition(d, k2 - 1, axis=1)[:, k2 - 1 : k2]
        near = d <= edge + 1e-9 * (own + norm.max()) + 1e-300
        for r, c in enumerate(near):
            c = np.flatnonzero(c)
            c = c[ids[c] != query_ids[at + r]]
            exact = np.sqrt(((x[c] - q[r]) ** 2).sum(1))
            best = np.lexsort((ids[c], exact))[:k]
            rows.append(np.full(len(best), at + r))
            found.append(ids[c][best])
            score.append(exact[best])
    return tuple(np.concatenate(a) if a else np.zeros(0) for a in (rows, found, score))


@dataclass
class Index:
    """What routes vectors to parts: of fixed size, whatever the table's."""

    parts: int
    dim: int
    router: Router | None
    mass: float

    def own(self, x: np.ndarray) -> np.ndarray:
        return self.router.probabilities(x).argmax(1) if self.router else np.zeros(len(x), np.int64)

    def visits(self, x: np.ndarray) -> list[np.ndarray]:
        if not self.router:
            return [np.zeros(1, np.int64)] * len(x)
        return [o[:n] for o, n in zip(*self._ordered(x))]

    def _ordered(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.router.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        sums = np.cumsum(np.take_along_axis(p, order, 1), axis=1)
        return order, np.maximum((sums < self.mass).sum(1) + 1, min(PROBES, self.parts)).clip(max=self.parts)


def fit_index(x: np.ndarray, rows: int, part_rows: int | None = None, recall: float = RECALL) -> Index:
    """x: the sample; rows: those of the table. A fifth of the sample is held out to find the probability that visits must hold."""
    parts = int(min(rows // (part_rows or PART_ROWS), len(x) // LEARNT_FROM))
    if parts < 2:
        return Index(1, x.shape[1] if x.ndim == 2 else 0, None, 1.0)
    held, rest = x[: len(x) // 5], x[len(x) // 5 :]
    graph = neighbour_graph(rest)
    router = fit_router(rest, graph, balanced_parts(rest, graph, parts), parts)
    norm, near = (rest * rest).sum(1), []
    for at in range(0, len(held), 1024):
        near.append(np.argpartition(norm - 2 * held[at : at + 1024] @ rest.T, 10, axis=1)[:, :10])
    of = router.probabilities(rest).argmax(1)[np.concatenate(near)]
    p = router.probabilities(held)
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, 1), axis=1) - np.take_along_axis(p, order, 1)
    place = np.argsort(order, axis=1, kind="stable")
    needed = np.take_along_axis(before, np.take_along_axis(place, of, 1), 1)  # a part is visited if those before it hold less
    return Index(parts, x.shape[1], router, float(np.quantile(needed, recall)) + 1e-9)


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def search(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row that `is_query` marks, among all other rows of `df`."""
    import pyarrow as pa

    spark = df.sparkSession
    flagged = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    good = stored(flagged.where(usable(F.col("v")) & F.col("id").isNotNull()).withColumn("v", F.col("v").cast(df.schema[vector_col].dataType)), "ann-rows")
    common = good.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    good = good.where(F.size("v") == common.dim)
    hashed = good.withColumn("__h", F.xxhash64("v"))
    crowded = stored(hashed.groupBy("__h").count().where(F.col("count") > k).select("__h"), "ann-crowded")
    crowded = F.broadcast(crowded) if crowded.count() <= CROWDED else crowded
    few = hashed.join(crowded, "__h", "left_semi").withColumn("__n", F.expr("dense_rank() over (partition by __h, v order by id)")).where(F.col("__n") <= k + 1)
    few = few.withColumn("__n", F.expr("row_number() over (partition by __h, v, id order by id)")).where(F.col("__n") <= k)
    few = hashed.join(crowded, "__h", "left_anti").select("id", "v").unionByName(few.select("id", "v"))
    base = stored(few.select("id", "v"), "ann-base")
    chosen = base.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()
    index = fit_index(_matrix(chosen.column(0).combine_chunks(), common.dim) if chosen.num_rows else np.zeros((0, common.dim)), base.count())
    shared = spark.sparkContext.broadcast(index)

    def assign(batches):
        for batch in batches:
            part = shared.value.own(_matrix(batch.column(1), shared.value.dim)) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(part.astype(np.int32))], names=["id", "v", "part"])

    def route(batches):
        for batch in batches:
            if batch.num_rows:
                visits = shared.value.visits(_matrix(batch.column(1), shared.value.dim))
                row = pa.array(np.repeat(np.arange(batch.num_rows), [len(p) for p in visits]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(np.concatenate(visits).astype(np.int32))], names=["id", "v", "part"])

    kind = base.schema["v"].dataType.simpleString()
    placed = stored(map_arrow(base, assign, f"id long, v {kind}, part int"), "ann-placed")
    asked = stored(map_arrow(good.where("q").select("id", "v").distinct(), route, f"id long, v {kind}, part int"), "ann-asked")

    def tiles(rows: DataFrame) -> Column:
        counts = dict(rows.groupBy("part").count().collect())  # a row for each part
        return F.array(*(F.lit(-(-counts.get(p, 0) // TILE)) for p in range(index.parts)))

    ours, theirs = tiles(placed), tiles(asked)
    left = _tiled(placed, ours, theirs, "ctile", "qtile")
    right = _tiled(asked, theirs, ours, "qtile", "ctile")

    def compare(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(q):
            return pd.DataFrame({"query_id": [], "mark": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "mark": "int64", "vec_id": "int64", "score": "float64"})
        rows, found, score = nearest(np.stack(q["v"]).astype(np.float64), q["id"].to_numpy(), np.stack(c["v"]).astype(np.float64), c["id"].to_numpy(), k)
        rows = rows.astype(np.int64)
        return pd.DataFrame({"query_id": q["id"].to_numpy()[rows], "mark": q["mark"].to_numpy()[rows], "vec_id": found.astype(np.int64), "score": score})

    keys = ("part", "ctile", "qtile")
    right = right.withColumn("mark", F.xxhash64("v"))
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "query_id long, mark long, vec_id long, score double")
    ranked = met.withColumn("rank", F.expr("row_number() over (partition by query_id, mark order by score, vec_id)")).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _tiled(rows: DataFrame, own: Column, other: Column, mine: str, others: str) -> DataFrame:
    """Each row in one tile of its side, once for each tile of the other side's rows in its part; rows that meet nothing go."""
    n = F.get(other, F.col("part"))
    placed = rows.where(n > 0).select("id", "v", "part", F.pmod(F.xxhash64("id", "v"), F.get(own, F.col("part"))).cast("int").alias(mine), n.alias("__n"))
    return placed.withColumn(others, F.explode(F.expr("sequence(0, __n - 1)"))).drop("__n")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


QUERIES = {"op4_neighbours": op4_neighbours}
SQL: dict[str, str] = {}
