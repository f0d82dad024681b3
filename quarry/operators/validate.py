"""Validation: ordered rules with a tagged reason, ledgers, key and reference checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip


def first_reason(rules: Sequence[tuple[str | Column, Column]]) -> Column:
    """The reason of the first rule that holds, else null. A reason may be an expression, e.g. with the names of missing keys."""
    lit = lambda r: F.lit(r) if isinstance(r, str) else r
    ladder = reduce(lambda w, r: w.when(F.coalesce(r[1], F.lit(False)), lit(r[0])), rules[1:], F.when(F.coalesce(rules[0][1], F.lit(False)), lit(rules[0][0])))
    return ladder.otherwise(F.lit(None))


def split_rejects(df: DataFrame, reason: Column, source: str = "", line: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and rejected ones with _reject_reason, _source_shard and _source_line."""
    tagged = df.withColumn("_reject_reason", reason)
    rejected = tagged.where("_reject_reason is not null").withColumn("_source_shard", F.lit(source)).withColumn("_source_line", line if line is not None else F.lit(None).cast("long"))
    return tagged.where("_reject_reason is null").drop("_reject_reason"), rejected


def json_rules(raw: str, required: Sequence[str], nested: Sequence[str], named: dict[str, str]) -> Column:
    """The cascade for lines of JSON: UTF-8, JSON, an object, its keys, nested objects, values that must not be empty.

    raw: a binary or string column. required: top keys. nested: those that must be objects. named: a JSON path for each label.
    """
    text = F.col(raw).cast("string")
    parsed = F.try_parse_json(text)
    keys = F.json_object_keys(text)
    missing = F.array_except(F.array(*map(F.lit, required)), keys)
    flat = [k for k in nested]
    bad = F.filter(F.array(*(F.when(F.substring(F.schema_of_variant(F.try_variant_get(parsed, f"$.{k}", "variant")), 1, 6) != "OBJECT", F.lit(k)) for k in flat)), lambda x: x.isNotNull()) if flat else F.array()
    empty = F.filter(F.array(*(F.when(F.trim(F.coalesce(F.get_json_object(text, p), F.lit(""))) == "", F.lit(k)) for k, p in named.items())), lambda x: x.isNotNull())
    return first_reason([
        ("invalid_utf8", ~F.is_valid_utf8(text)),
        ("bad_json", parsed.isNull()),
        ("not_object", F.substring(F.schema_of_variant(parsed), 1, 6) != "OBJECT"),
        (F.concat(F.lit("missing_keys:"), F.array_join(missing, ",")), F.size(missing) > 0),
        (F.concat(F.lit("not_object:"), F.array_join(bad, ",")), F.size(bad) > 0),
        (F.concat(F.lit("empty:"), F.array_join(empty, ",")), F.size(empty) > 0),
    ])


def ledger(df: DataFrame, reason: str, duplicate: str, by: Sequence[str] = ()) -> DataFrame:
    """rows_in, kept, duplicates, rejects and whether they close, by groups; one pass, partial sums before the shuffle."""
    rejected, copied = F.col(reason).isNotNull(), F.coalesce(F.col(duplicate), F.lit(False))
    out = df.groupBy(*by).agg(F.count("*").alias("rows_in"), F.count_if(~rejected & ~copied).alias("kept"), F.count_if(~rejected & copied).alias("duplicates"), F.count_if(rejected).alias("rejects"))
    return out.withColumn("closes", F.col("kept") + F.col("duplicates") + F.col("rejects") == F.col("rows_in"))


def ledger_by_key(df: DataFrame, reason: str, key: str, seq: str, by: Sequence[str] = ()) -> DataFrame:
    """The ledger of rows whose duplicates are told by key: the first of a key, by `seq`, is kept. Rows are read once and
    counted by key before anything else; what is compared then are groups, of which a key has as many as `by` has values."""
    groups = df.groupBy(*by, F.col(reason).isNull().alias("__good"), F.col(key).alias("__key")).agg(F.count("*").alias("__n"), F.min(seq).alias("__min"))
    first = F.min("__min").over(Window.partitionBy("__key", "__good"))
    kept = F.when(F.col("__good") & (F.col("__min") == F.col("__first")), 1).otherwise(0)
    groups = groups.withColumn("__first", first).withColumn("__kept", kept)
    good = F.when(F.col("__good"), F.col("__n")).otherwise(0)
    out = groups.groupBy(*by).agg(F.sum("__n").alias("rows_in"), F.sum("__kept").alias("kept"), F.sum(good - F.col("__kept")).alias("duplicates"), F.sum(F.when(F.col("__good"), 0).otherwise(F.col("__n"))).alias("rejects"))
    return out.withColumn("closes", F.col("kept") + F.col("duplicates") + F.col("rejects") == F.col("rows_in"))


def column_problems(df: DataFrame, required: Sequence[str], filename: str = "") -> list[str]:
    """What is wrong with a table's header: empty, repeated or missing names."""
    names = [c.strip() for c in df.columns]
    problems = [f"{filename}: empty column name"] if any(not c for c in names) else []
    problems += [f"{filename}: repeated column {c}" for c in sorted({c for c in names if names.count(c) > 1})]
    return problems + [f"{filename}: missing column {c}" for c in required if c not in names]


def key_problems(df: DataFrame, key: str) -> DataFrame:
    """problem, value, n: empty and repeated keys."""
    own = F.trim(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return df.groupBy(own.alias("value")).agg(F.count("*").alias("n")).where("value = '' or n > 1").select(F.when(F.col("value") == "", "empty").otherwise("repeated").alias("problem"), "value", "n")


def missing_references(edges: DataFrame, column: str, nodes: DataFrame, key: str) -> DataFrame:
    """empty, missing and distinct missing references of an edge table."""
    own = F.col(column).cast("string")
    empty = F.coalesce(F.trim(own) == "", F.lit(True))
    found = nodes.select(F.col(key).cast("string").alias("__key")).distinct()
    lost = edges.select(own.alias("__ref"), empty.alias("__empty")).join(found, F.col("__ref") == F.col("__key"), "left")
    gone = ~F.col("__empty") & F.col("__key").isNull()
    by_ref = lost.groupBy("__ref").agg(F.count_if("__empty").alias("empty"), F.count_if(gone).alias("missing"))
    return by_ref.agg(F.coalesce(F.sum("empty"), F.lit(0)).alias("empty"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"), F.count_if(F.col("missing") > 0).alias("missing_distinct"))


def disagreements(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys that only one side has, or whose columns differ: key, problem."""
    a, b = left.select(F.col(key).alias("__a"), *(F.col(c).alias(f"__a_{c}") for c in columns)), right.select(F.col(key).alias("__b"), *(F.col(c).alias(f"__b_{c}") for c in columns))
    differ = reduce(lambda x, y: x | y, (~F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}")) for c in columns), F.lit(False))
    both = a.join(b, F.col("__a") == F.col("__b"), "full_outer")
    problem = F.when(F.col("__b").isNull(), "only_left").when(F.col("__a").isNull(), "only_right").when(differ, "differs")
    return both.select(F.coalesce("__a", "__b").alias(key), problem.alias("problem")).where("problem is not null")


def conforms(df: DataFrame, schema: T.StructType) -> bool:
    """Whether a table has exactly these fields, in this order."""
    return [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]


def same_keys(text: Column, keys: Sequence[str]) -> Column:
    """Whether a JSON object has exactly these keys, in any order."""
    return F.array_sort(F.json_object_keys(text)) == F.array(*map(F.lit, sorted(keys)))


def long_enough(text: str, key: str, least: int = 30) -> Column:
    """Whether a row has an id and, without white space at its ends, a text of `least` characters."""
    return (F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) != "") & (F.length(strip(F.coalesce(F.col(text), F.lit("")))) >= least)


def oversize(df: DataFrame, text: str, most: int = 2000) -> DataFrame:
    """rows, oversize: how many texts have more than `most` characters."""
    return df.agg(F.count("*").alias("rows"), F.count_if(F.length(text) > most).alias("oversize"))


def zip_rows(left: DataFrame, right: DataFrame, place: str, equal: str) -> DataFrame:
    """Rows of two tables joined by their place. Tables of different length, a repeated place, and rows of one place whose `equal` differs are errors, raised where they are met."""
    mine = left.select(F.col(place).alias("__p"), F.col(equal).alias("__e"), F.struct(*left.columns).alias("__l"))
    yours = right.select(F.col(place).alias("__q"), F.col(equal).alias("__f"), F.struct(*[c for c in right.columns if c not in (place, equal)]).alias("__r"))
    single = lambda df, k: df.groupBy(k).agg(F.count("*").alias(f"__n{k}"), *(F.first(c).alias(c) for c in df.columns if c != k))
    both = single(mine, "__p").join(single(yours, "__q"), F.col("__p") == F.col("__q"), "full_outer")
    wrong = F.when((F.col("__n__p") > 1) | (F.col("__n__q") > 1), "repeated place").when(F.col("__p").isNull(), "only right").when(F.col("__q").isNull(), "only left").when(~F.col("__e").eqNullSafe(F.col("__f")), "rows differ")
    message = F.concat(wrong, F.lit(" at "), F.coalesce("__p", "__q").cast("string"))
    checked = both.withColumn("__l", F.when(wrong.isNull(), F.col("__l")).otherwise(F.raise_error(message).cast(both.schema["__l"].dataType)))
    return checked.select("__l.*", "__r.*")
