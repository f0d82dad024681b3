"""Readers: tolerant JSON lines, CSV with byte order marks and quoted line feeds, id lists, question sets, predictions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, place, line: place orders a file's lines. Globs are expanded, files counted once."""
    lines = spark.read.text(paths if isinstance(paths, str) else sorted(set(paths)))
    return lines.select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))


def binary_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines as bytes, with their length, so that broken UTF-8 can be told from good."""
    return text_lines(spark, paths).withColumn("raw", F.col("line").cast("binary")).withColumn("n_bytes", F.octet_length("line")).drop("line")


def json_lines(spark: SparkSession, paths: str | list[str], schema: T.StructType | str, keep_broken: bool = False, limit: int | None = None) -> DataFrame:
    """Records of JSON lines; blank lines are left out. Broken ones are left out too, or kept with record null."""
    lines = text_lines(spark, paths).where(F.trim("line") != "")
    lines = lines.limit(limit) if limit is not None else lines
    parsed = lines.withColumn("record", F.when(F.try_parse_json("line").isNotNull(), F.from_json("line", schema, {"mode": "PERMISSIVE"})))
    return parsed if keep_broken else parsed.where("record is not null")


def csv_table(spark: SparkSession, paths: str | list[str], required: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """A CSV with header, all text: the byte order mark taken off, quoted line feeds kept, empty cells empty strings, ragged rows filled up or cut."""
    raw = spark.read.csv(paths, header=True, multiLine=True, quote='"', escape='"', maxCharsPerColumn=-1, mode="PERMISSIVE", encoding="UTF-8")
    raw = raw.toDF(*(c.lstrip("\ufeff") for c in raw.columns))
    lost = [c for c in required if c not in raw.columns]
    if lost:
        raise ValueError(f"missing columns: {', '.join(lost)}")
    return with_columns(raw.na.fill(""), columns) if columns else raw.na.fill("")


def with_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """`df` with exactly these columns; those that it lacks are null."""
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns))


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """id, place: the distinct ids of a file, without blank lines and comments, where each stands first."""
    ids = text_lines(spark, path).select(F.trim("line").alias("id"), "place").where("id <> '' and not startswith(id, '#')")
    return ids.groupBy("id").agg(F.min("place").alias("place"))


def question_sets(spark: SparkSession, paths: str | list[str], key: str = "test_id") -> DataFrame:
    """Question sets with `dataset`, the name of the folder; empty and repeated ids, blank questions and empty sets are errors."""
    rows = csv_table(spark, paths, [key, "question"])
    rows = rows.withColumn("dataset", F.element_at(F.split(F.input_file_name(), "/"), -2))
    bad = rows.groupBy("dataset", key).count().where(f"trim({key}) = '' or count > 1").limit(5).collect()
    if bad:
        raise ValueError(f"empty or repeated ids: {[(r.dataset, r[key], r['count']) for r in bad]}")
    blank = rows.where(F.trim("question") == "").select(key).limit(5).collect()
    if blank:
        raise ValueError(f"blank questions: {[r[key] for r in blank]}")
    if rows.isEmpty():
        raise ValueError("a question set without questions")
    return rows


def ad_hoc(text: str, **tables: DataFrame) -> DataFrame:
    """A query in SQL over the tables given by name, written in the text as {name}."""
    return next(iter(tables.values())).sparkSession.sql(text, **tables)


def table_count(table: DataFrame, distinct: str | None = None, where: Column | str | None = None) -> DataFrame:
    """n: rows, or distinct values of a column, of a table or of a part of it."""
    rows = table if where is None else table.where(where)
    return rows.agg((F.count_distinct(distinct) if distinct else F.count("*")).alias("n"))


def predictions(spark: SparkSession, path: str, key: str = "test_id") -> DataFrame:
    """test_id, answer: of repeated ids the last line counts; null is empty, other values are their text; broken lines are left out."""
    lines = text_lines(spark, path).where(F.try_parse_json("line").isNotNull())
    rows = lines.select(F.get_json_object("line", f"$.{key}").alias(key), F.coalesce(F.get_json_object("line", "$.answer"), F.lit("")).alias("answer"), "place")
    return rows.where(f"{key} is not null").groupBy(key).agg(F.max_by("answer", "place").alias("answer"))


def metrics(spark: SparkSession, path: str, patterns: dict[str, str]) -> DataFrame:
    """name, value: the first group of each pattern in a text file, null where it does not stand."""
    whole = spark.read.text(path, wholetext=True)
    each = F.array(*(F.struct(F.lit(n).alias("name"), F.nullif(F.regexp_extract("value", p, 1), F.lit("")).alias("value")) for n, p in patterns.items()))
    return whole.select(F.inline(each))


def rows_of(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of a table whose key is listed."""
    return table.join(ids.select(F.col("id").alias("__id")).distinct(), F.col(key) == F.col("__id"), "left_semi")


def page(table: DataFrame, key: str, after: object, size: int) -> DataFrame:
    """The page behind a key, by key."""
    return (table if after is None else table.where(F.col(key) > F.lit(after))).orderBy(key).limit(size)
