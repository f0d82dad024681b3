"""The corpus pipeline: toxicity, exact and near duplicates, the mix of sources, and tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from quarry.llm.shared import documents, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below the threshold. The model is trained on the labelled rows among `docs`."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_documents(docs, model, out="__score").where(F.col("__score") < toxicity.THRESHOLD).drop("__score")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return near_dedup.drop_near(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as they are taken."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each row: doc_id, lang, source, n_tokens and digests of the ids and of the text they decode to."""
    return bpe.digest_documents(docs, bpe.default_path(), keep=["doc_id", "lang", "source"])


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near), ("mixing", mix), ("bpe", encode)]

#: Trees, MinHash buckets, dynamic programming and merges have no SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
