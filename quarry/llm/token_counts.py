"""Token counts as rollups that signed deltas maintain.

A batch holds changes of documents: inserts, deletes and revised counts. Its signed sums by source, language
and tokenizer version are written as one small table under the batch's name, and totals are the sums of all
committed batches and of the base that earlier ones were folded into. A batch counts once its success file
is there. A batch of a name that is committed already, or folded, is not applied again, and one that broke
off is written anew: repeating a commit never changes totals.

Defined cases. Null source, language and version are groups of their own, and a null count is 0. A revision
without an old count counts as revised from 0. Any other change than insert, delete or revise is an error.
A group whose documents and tokens are both 0 is left out of the totals. An empty batch is committed and
changes nothing. Other columns of the changes are ignored.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .exact_dedup import mark_copies, text_sha256
from .shared import documents, map_arrow, remove, scratch, stored
from .token_files import default_path, encoder_of, read_spec

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, documents long, tokens long"


def signed(changes: DataFrame) -> DataFrame:
    """source, lang, tokenizer, documents, tokens: the sums of a batch. changes: op, source, lang, tokenizer, n_tokens, old_tokens."""
    n, old = F.coalesce(F.col("n_tokens"), F.lit(0)), F.coalesce(F.col("old_tokens"), F.lit(0))
    wrong = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(F.col("op"), F.lit("null"))))
    rows = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).when(F.col("op") == "revise", 0).otherwise(wrong.cast("int"))
    tokens = F.when(F.col("op") == "insert", n).when(F.col("op") == "delete", -n).otherwise(n - old)
    return changes.groupBy(*KEYS).agg(F.sum(rows).alias("documents"), F.sum(tokens).alias("tokens"))


class Rollup:
    """Totals kept under `root`, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self.fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _exists(self, name: str) -> bool:
        return self.fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}"))

    def _folders(self, kind: str) -> list[str]:
        if not self._exists(kind):
            return []
        found = self.fs.listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}"))
        names = sorted(s.getPath().getName() for s in found if s.isDirectory())
        return [n for n in names if self._exists(f"{kind}/{n}/_SUCCESS")]

    def _base(self) -> tuple[str | None, list[str]]:
        """The newest base, and the batches that are in it."""
        bases = self._folders("base")
        if not bases:
            return None, []
        lines = self.spark.read.text(f"{self.root}/folded/{bases[-1]}").collect()  # one row
        return bases[-1], json.loads(lines[0].value)

    def committed(self) -> list[str]:
        return sorted({*self._folders("batch"), *self._base()[1]})

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Applies a batch, unless one of its name is there. Says whether it did."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.-]*", batch):
            raise ValueError(f"not a batch name: {batch}")
        if batch in self.committed():
            return False
        signed(changes).write.mode("overwrite").parquet(f"{self.root}/batch/{batch}")
        return True

    def totals(self) -> DataFrame:
        return self._sums(self._folders("batch"))

    def _sums(self, batches: list[str]) -> DataFrame:
        """Sums of the base and of those batches that are not in it."""
        base, inside = self._base()
        paths = [f"{self.root}/batch/{b}" for b in batches if b not in inside]
        paths += [f"{self.root}/base/{base}"] if base else []
        if not paths:
            return self.spark.createDataFrame([], DELTA)
        sums = self.spark.read.schema(DELTA).parquet(*paths).groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where("documents <> 0 or tokens <> 0")

    def fold(self) -> None:
        """Puts the batches that are there now into a new base; one that comes meanwhile stays a batch. The list of what the base holds is written first; the base counts once its success file is there."""
        (base, inside), batches = self._base(), self._folders("batch")
        number, sums = f"{int(base) + 1 if base else 0:012d}", self._sums(batches)
        self.spark.createDataFrame([(json.dumps(sorted({*batches, *inside})),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.root}/folded/{number}")
        sums.write.mode("overwrite").parquet(f"{self.root}/base/{number}")
        for name in batches:
            remove(self.spark, f"{self.root}/batch/{name}")


def count_tokens(df: DataFrame, path: str, tokenizer: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`df`, or its columns `keep`, with string tokenizer and long n_tokens; null text has none."""
    import pyarrow as pa
    from pyspark.sql import types as T

    kept = [f for f in df.schema.fields if f.name not in ("tokenizer", "n_tokens") and (keep is None or f.name in keep)]
    names = [f.name for f in kept]
    shared = df.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batches):
        encoder = encoder_of(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                n = [len(encoder.encode(t.as_py())) // encoder.kind.itemsize for t in batch.column(text_col)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array([tokenizer] * len(n), pa.string()), pa.array(n, pa.int64())], names=[*names, "tokenizer", "n_tokens"])

    return map_arrow(df, run, T.StructType([*kept, T.StructField("tokenizer", T.StringType()), T.StructField("n_tokens", T.LongType())]))


def corpus_totals(docs: DataFrame, root: str, path: str, tokenizer: str) -> DataFrame:
    """Totals of `docs` (doc_id, text, lang, source) after every row came in with an estimate, a token for four characters, that batch came
    a second time, copies of equal texts went out, and the estimates of what stays were revised to the tokenizer's counts.

    Batches are made of the stored counts row by row, so that null and repeated ids do no harm: of equal texts one row stays.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "source", "lang", "text", text_sha256(F.col("text")).alias("sha"), F.floor(F.coalesce(F.length("text"), F.lit(0)) / 4).alias("estimate"))
    counted = count_tokens(texts, path, tokenizer, keep=["doc_id", "source", "lang", "sha", "estimate"]).withColumnRenamed("doc_id", "id").withColumn("row", F.monotonically_increasing_id())
    counted = stored(counted, "token-counts")
    marked = stored(mark_copies(counted).select(*KEYS, "n_tokens", "estimate", "kept"), "token-copies")
    change = lambda rows, op, n, old: rows.select(F.lit(op).alias("op"), *KEYS, n.alias("n_tokens"), old.cast("long").alias("old_tokens"))
    n, estimate, none = F.col("n_tokens"), F.col("estimate"), F.lit(None)
    rollup = Rollup(spark, root)
    rollup.commit("load", change(counted, "insert", estimate, none))
    rollup.commit("load", change(counted, "insert", estimate, none))
    rollup.commit("copies", change(marked.where("not kept"), "delete", estimate, none))
    rollup.fold()
    rollup.commit("counts", change(marked.where("kept"), "revise", n, estimate))
    return rollup.totals()


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_totals(documents(spark, sf_dir), scratch(spark, "rollup"), default_path(), "byte_bpe_50k")


QUERIES = {"op8_token_counts": op8_token_counts}
SQL: dict[str, str] = {}
