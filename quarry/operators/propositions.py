"""Propositions from model replies: prompts, calls with retries, parsing and normalisation, source fields by labels."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import json_array_text, strip
from .dedup import first_wins
from .validate import first_reason

# Predicates, kinds of conditions, and labels of sections in the order of their priority.
PREDICATES = ("适用对象", "资格要求", "数量限制", "时间限制", "禁止情形", "例外情形", "材料要求", "办理地点", "收费标准", "办理时限", "办理流程", "其他")
CONDITION_TYPES = ("资格要求", "数量限制", "时间限制", "禁止情形", "例外情形", "适用对象")
OTHER = "其他"
LEAST = 10
FIELD_LABELS = {
    "condition": ("受理条件", "办理条件", "申请条件", "准予条件", "审批条件"),
    "process": ("办理流程", "办理程序", "窗口办理", "网上办理", "办理方式"),
    "material": ("申请材料", "申报材料", "材料清单", "材料要求"),
    "fee": ("收费标准", "收费依据", "收费情况"),
    "timeLimit": ("办理时限", "法定时限", "承诺时限"),
    "legalBasis": ("设定依据", "法律依据", "法规依据", "政策依据"),
    "location": ("办理地点",),
    "supervision": ("监督投诉", "投诉举报", "咨询方式", "咨询电话"),
    "faq": ("常见问题",),
    "header": ("事项名称",),
}


def source_field(content: Column, labels: dict[str, tuple[str, ...]] = FIELD_LABELS) -> Column:
    """The first field, by priority, one of whose labels stands in the content; else other."""
    return F.coalesce(first_reason([(field, F.regexp_like(content, F.lit("|".join(words)))) for field, words in labels.items()]), F.lit("other"))


def prompt(title: str, service: str, doc: str, content: str, field: str, names: dict[str, str]) -> Column:
    """The text a model is asked: a heading from the first id that is filled, the field's name, the content."""
    head = F.coalesce(*(F.nullif(F.trim(F.col(c)), F.lit("")) for c in (title, service, doc)), F.lit(""))
    label = F.coalesce(*(F.when(F.col(field) == k, F.lit(v)) for k, v in names.items()), F.lit("其他"))
    return F.concat(F.lit("事项："), head, F.lit("\n栏目："), label, F.lit("\n内容：\n"), F.col(content))


class Refused(Exception):
    """A reply of a service with a status; 429 and those from 500 on are worth another try."""

    def __init__(self, status: int, text: str = ""):
        super().__init__(f"status {status} {text}".strip())
        self.status = status


def tried(call: Callable[[str], str], text: str, retries: int, wait: float, check: Callable[[str], bool] | None) -> tuple[str | None, str | None]:
    """reply, error. Timeouts, lost connections, busy services and replies that `check` does not take are tried again."""
    error = None
    for k in range(retries + 1):
        try:
            reply = call(text)
            if check is None or check(reply):
                return reply, None
            error = "the reply has not the expected shape"
        except (TimeoutError, ConnectionError, Refused) as e:
            error = f"{type(e).__name__}: {e}"
            if isinstance(e, Refused) and e.status != 429 and e.status < 500:
                break
        except Exception as e:  # noqa: BLE001  anything else is not tried again
            error = f"{type(e).__name__}: {e}"
            break
        if k < retries and wait:
            time.sleep(wait * 2**k)
    return None, error


def in_flight(call: Callable[[str], tuple], texts: Iterable[str], workers: int) -> Iterator[tuple]:
    """Results in the order of the texts, with at most twice as many calls begun as there are workers."""
    with ThreadPoolExecutor(workers) as pool:
        waiting: deque = deque()
        for text in texts:
            waiting.append(pool.submit(call, text))
            if len(waiting) >= 2 * workers:
                yield waiting.popleft().result()
        while waiting:
            yield waiting.popleft().result()


def ask(df: DataFrame, prompt_col: str, client: Callable[[], Callable[[str], str]], retries: int = 1, wait: float = 0.0, workers: int = 1, check: Callable[[str], bool] | None = None) -> DataFrame:
    """`df` with reply and error. `client` makes a caller in each task, which has `workers` threads; see `tried` for what is tried again."""
    from pyspark.sql import types as T

    def run(batches):
        call = client()
        for pdf in batches:
            found = list(in_flight(lambda text: tried(call, text, retries, wait, check), pdf[prompt_col], workers))
            replies, errors = [r for r, _ in found], [e for _, e in found]
            yield pdf.assign(reply=pd.Series(replies, index=pdf.index, dtype=object), error=pd.Series(errors, index=pdf.index, dtype=object))

    kept = [f for f in df.schema.fields if f.name not in ("reply", "error")]
    return df.mapInPandas(run, T.StructType([*kept, T.StructField("reply", T.StringType()), T.StructField("error", T.StringType())]))


def parse(replies: DataFrame, key: str, reply: str, field: str) -> tuple[DataFrame, DataFrame]:
    """(propositions, counts) of replies: key, seq, predicate, condition_type, object_value, statement; and what was dropped or changed.

    A reply's propositions are read from its JSON array. An unknown predicate becomes `其他`, statements under ten characters go, of
    equal statements in a block the first stays, and only condition blocks keep a known condition type.
    """
    kind = "array<struct<predicate:string,objectValue:string,statement:string,conditionType:string>>"
    parsed = replies.select(F.col(key).alias("key"), F.col(field).alias("field"), F.from_json(json_array_text(reply), kind).alias("items"))
    each = parsed.where("items is not null").select("key", "field", F.posexplode("items").alias("seq", "x"))
    text = lambda c: strip(F.coalesce(F.col(f"x.{c}"), F.lit("")))
    rows = each.select("key", "field", "seq", text("predicate").alias("p"), text("statement").alias("statement"), text("objectValue").alias("object_value"), text("conditionType").alias("ct"))
    known, is_condition = F.col("p").isin(*PREDICATES), F.col("field") == "condition"
    rows = rows.withColumn("known", known).withColumn("predicate", F.when(known, F.col("p")).otherwise(OTHER)).withColumn("good", F.length("statement") >= LEAST)
    rows = rows.withColumn("condition_type", F.when(is_condition & F.col("ct").isin(*CONDITION_TYPES), F.col("ct")).otherwise(""))
    kept = first_wins(rows.where("good"), ["key", "statement"], ["seq"])
    wrong_type = is_condition & (F.col("ct") != "") & ~F.col("ct").isin(*CONDITION_TYPES)
    counts = rows.groupBy("key").agg(F.count("*").alias("raw"), F.count_if(~F.col("known")).alias("invalid_predicate"), F.count_if(~F.col("good")).alias("bad_statement"), F.count_if(F.col("good") & wrong_type).alias("invalid_condition_type"))
    n = kept.groupBy(F.col("key").alias("__k")).agg(F.count("*").alias("__n"))
    counts = counts.join(n, F.col("key") == F.col("__k"), "left").withColumn("kept", F.coalesce("__n", F.lit(0))).withColumn("duplicate", F.col("raw") - F.col("bad_statement") - F.col("kept")).drop("__k", "__n")
    return kept.select("key", "seq", "predicate", "condition_type", "object_value", "statement"), counts


def status(replies: DataFrame, reply: str = "reply", error: str = "error") -> Column:
    """ok, empty, parse_error or failed."""
    items = F.from_json(json_array_text(reply), "array<string>")
    return F.when(F.col(error).isNotNull(), "failed").when(items.isNull(), "parse_error").when(F.size(items) == 0, "empty").otherwise("ok")


def density(counts: DataFrame, by: str) -> DataFrame:
    """Blocks, propositions and propositions a block."""
    return counts.groupBy(by).agg(F.count("*").alias("blocks"), F.sum("kept").alias("propositions"), F.round(F.avg("kept"), 6).alias("density"))
