"""Exact vector search, worklists of vectors to fill, and an embedder for tests and offline runs."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import first_n


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where a vector has no length."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def missing(v: Column) -> Column:
    """Null, empty or all zeros."""
    return v.isNull() | (F.size(v) == 0) | F.forall(v, lambda x: F.coalesce(x, F.lit(0)) == 0)


def top_k(index: DataFrame, vector: Sequence[float], k: int, id_col: str, vector_col: str, floor: float = -1.0, digits: int = 6) -> DataFrame:
    """The k most similar rows of an index to one vector, at or above a floor: a scan with a bounded heap in each task."""
    target = F.array(*(F.lit(float(x)) for x in vector))
    score = F.round(cosine(F.col(vector_col), target), digits)
    return index.where(~missing(F.col(vector_col))).withColumn("score", score).where(F.col("score") >= floor).orderBy(F.desc("score"), id_col).limit(k)


def search_all(queries: Iterable[tuple[str, DataFrame, str, str, str, int, float]], vector: Sequence[float]) -> DataFrame:
    """label, id, name, score of several indexes for one vector, best first. A query: label, index, id, vector and name columns, k, floor."""
    found = None
    for label, index, id_col, vector_col, name_col, k, floor in queries:
        best = top_k(index, vector, k, id_col, vector_col, floor).select(F.lit(label).alias("label"), F.col(id_col).cast("string").alias("id"), F.col(name_col).cast("string").alias("name"), "score")
        found = best if found is None else found.unionByName(best)
    return found.orderBy(F.desc("score"), "label", "id")


def best_by_name(seeds: DataFrame, n: int) -> DataFrame:
    """The n best seeds of distinct names; a seed list is a few rows."""
    return first_n(seeds, ["name"], [F.desc("score"), "id"], 1).orderBy(F.desc("score"), "id").limit(n)


def worklist(rows: DataFrame, text: str, vector: str, id_col: str, done: DataFrame | None = None, force: bool = False) -> DataFrame:
    """`rows` with `state`: skipped_empty, skipped_done (listed or filled) or todo."""
    blank = F.trim(F.coalesce(F.col(text), F.lit(""))) == ""
    filled = F.lit(False) if force else ~missing(F.col(vector))
    listed = done.select(F.col(id_col).alias("__done")).distinct() if done is not None else rows.sparkSession.createDataFrame([], "__done long")
    joined = rows.join(listed, F.col(id_col) == F.col("__done"), "left")
    return joined.withColumn("state", F.when(blank, "skipped_empty").when(F.col("__done").isNotNull() | filled, "skipped_done").otherwise("todo")).drop("__done")


def hashing_embedder(dim: int = 64) -> Callable[[list[str]], list[list[float]]]:
    """A stand-in for a remote embedder: words and character pairs hashed to signed places, scaled to length 1."""

    def embed(texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = [0.0] * dim
            low = (text or "").lower()
            for part in re.findall(r"\w+", low) + [low[i : i + 2] for i in range(len(low) - 1)]:
                h = int.from_bytes(hashlib.blake2b(part.encode(), digest_size=8).digest(), "big")
                v[h % dim] += 1.0 if h >> 63 else -1.0
            size = sum(x * x for x in v) ** 0.5
            out.append([x / size for x in v] if size else v)
        return out

    return embed


def embed_column(df: DataFrame, text: str, out: str, embed: Callable[[list[str]], list[list[float] | None]], dim: int, batch: int = 64, most_chars: int = 2000, failures: int = 16) -> DataFrame:
    """`df` with array<float> `out` from an embedder that is called with batches of texts, cut to `most_chars`, the model's input size.

    A batch that fails is tried text by text; a text that fails or has another length of vector is null. After `failures`
    failures in a row the task fails.
    """
    from pyspark.sql import types as T

    def run(batches):
        bad = 0
        for pdf in batches:
            vectors: list = []
            texts = [(t or "")[:most_chars] for t in pdf[text]]
            for at in range(0, len(texts), batch):
                part = texts[at : at + batch]
                try:
                    got = embed(part)
                except Exception:  # noqa: BLE001  an embedder may fail in any way
                    got = []
                    for t in part:
                        try:
                            got += embed([t])
                        except Exception:  # noqa: BLE001
                            got.append(None)
                for v in got:
                    ok = v is not None and len(v) == dim
                    bad = 0 if ok else bad + 1
                    if bad >= failures:
                        raise RuntimeError(f"{bad} texts in a row got no vector")
                    vectors.append([float(x) for x in v] if ok else None)
            yield pdf.assign(**{out: pd.Series(vectors, index=pdf.index, dtype=object)})

    fields = [f for f in df.schema.fields if f.name != out]
    return df.select(*(f.name for f in fields)).mapInPandas(run, T.StructType([*fields, T.StructField(out, T.ArrayType(T.FloatType()))]))


def vector_property(name: str) -> str:
    """_snake_case_vector of a camelCase property."""
    return "_" + re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower() + "_vector"


def write_back(nodes: DataFrame, vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """`nodes` with the vectors of those that have a new one."""
    new = vectors.select(F.col(id_col).alias("__id"), F.col(vector_col).alias("__v"))
    return nodes.join(new, F.col(id_col) == F.col("__id"), "left").withColumn(vector_col, F.coalesce("__v", vector_col)).drop("__id", "__v")
