"""Two raw record formats materialised as one nested record, and columns put together for imports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.text import first_filled, with_unit


def _v(raw: str, path: str) -> Column:
    return scalar(F.try_variant_get(F.col(raw), path, "variant"))


def scalar(value: Column) -> Column:
    """A variant as text: null and structures are empty, booleans 是 or 否."""
    kind, text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    flag = F.when(text == "true", "是").otherwise("否")
    return F.when(kind == "BOOLEAN", flag).when(F.substring(kind, 1, 5).isin("ARRAY", "OBJEC"), "").otherwise(F.coalesce(text, F.lit("")))


def _list(raw: str, path: str, fields: dict[str, Sequence[str]]) -> Column:
    """Objects of a list as structs of text; each field is the first filled of some keys. What is no object is left out."""
    items = F.try_variant_get(F.col(raw), path, "array<variant>")
    one = lambda x, k: F.coalesce(F.try_variant_get(x, f"$.{k}", "string"), F.lit(""))
    objects = F.filter(F.coalesce(items, F.array().cast("array<variant>")), lambda x: F.substring(F.schema_of_variant(x), 1, 6) == "OBJECT")
    return F.transform(objects, lambda x: F.struct(*(first_filled(*(one(x, k) for k in ks)).alias(name) for name, ks in fields.items())))


def channels(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def materialise(lines: DataFrame, line: str = "line") -> DataFrame:
    """`lines` with variant (v1, v2 or null) and the unified record's columns: code, name, org, target, address, channels, promise, steps, results, materials, laws.

    v1 has the item's keys in upper case, v2 is a package with keys in lower case. The code falls back to other ids of the item.
    """
    rows = lines.withColumn("__raw", F.try_parse_json(line))
    item = F.coalesce(F.try_variant_get("__raw", "$.AUDIT_ITEM[0]", "variant"), F.try_variant_get("__raw", "$.AUDIT_ITEM", "variant"))
    rows = rows.withColumn("__item", item)
    first = F.col("__item").isNotNull() & (F.substring(F.schema_of_variant("__item"), 1, 6) == "OBJECT") & (F.schema_of_variant("__item") != "OBJECT<>")
    second = F.try_variant_get("__raw", "$.catalog_name", "variant").isNotNull() | (_v("__raw", "$.special_item_type") == "TC")
    rows = rows.withColumn("variant", F.when(first, "v1").when(second, "v2"))
    i, r = (lambda k: _v("__item", f"$.{k}")), (lambda k: _v("__raw", f"$.{k}"))
    pick = lambda a, b: F.when(F.col("variant") == "v1", a).when(F.col("variant") == "v2", b)
    return rows.select(
        *lines.columns, "variant",
        pick(first_filled(i("ITEM_ID"), i("TASK_CODE"), i("ROWGUID"), i("NATION_TASK_CODE")), r("id")).alias("code"),
        pick(i("CATANAME"), first_filled(r("catalog_name"), r("subject_name"))).alias("name"),
        pick(i("DEPT_NAME"), r("impl_org_name")).alias("org"),
        pick(i("SERVE_TYPE_TEXT"), r("service_object_text")).alias("target"),
        pick(first_filled(i("XHTSDZ"), _v("__raw", "$.AUDIT_CATALOG_LOBBY[0].ADDRESS")), _v("__raw", "$.window_list[0].address")).alias("address"),
        pick(channels(i("HANDLE_TYPE_TEXT")), channels(r("application_channel_text"))).alias("channels"),
        pick(i("ONLINECHECK_TEXT"), F.when(r("application_channel_text") == "", "").when(F.contains(r("application_channel_text"), F.lit("网上办理")), "是").otherwise("否")).alias("online"),
        pick(with_unit(i("PROMISE_DAY"), i("PROMISE_TYPE_TEXT")), with_unit(r("promise_time"), r("promise_time_unit_text"))).alias("promise"),
        pick(_list("__raw", "$.AUDIT_ITEM_FLOWSHEET", {"step": ["STEP_TEXT"], "link": ["UNTI_LINK_TEXT"], "handler": ["TRANSACTOR"]}), F.array().cast("array<struct<step:string,link:string,handler:string>>")).alias("steps"),
        pick(_list("__raw", "$.AUDIT_ITEM_RESULT", {"name": ["NAME"], "kind": ["RESULT_TYPE_TEXT", "SUBJECT_RESULT_TYPE_TEXT"]}), _list("__raw", "$.result_sample_list", {"name": ["name"], "kind": ["subject_result_type_text"]})).alias("results"),
        pick(_list("__raw", "$.AUDIT_MATERIAL", {"name": ["MATERIAL_NAME"], "seq": ["ORDERNUM"], "note": ["MATERIAL_DESC", "FILL_EXPLIAN"]}), _list("__raw", "$.submit_material_list", {"name": ["document_name"], "seq": ["sort_order"], "note": ["note"]})).alias("materials"),
        pick(_list("__item", "$.LAW", {"name": ["LAWNAME"], "doc": ["ACCORDINGNUMBER"], "article": ["TERMSNUMBER"], "content": ["TERMSCONTENT"]}), _list("__raw", "$.clause_list", {"name": ["legal_name"], "doc": ["reference_number"], "article": ["clause_number"], "content": ["content"]})).alias("laws"),
    )


def map_columns(df: DataFrame, mapping: dict[str, str | Sequence[str]]) -> DataFrame:
    """Columns under their properties' names; a column may become several, an empty list drops it."""
    return df.select(*(F.col(c).alias(t) for c, ts in mapping.items() for t in ([ts] if isinstance(ts, str) else ts)))


def with_routing(services: DataFrame, domain: str, category: str) -> DataFrame:
    """`services` with domain_id, category_id and model_id."""
    d = F.lit(domain)
    return services.withColumn("domain_id", F.concat(F.lit("domain:"), d)).withColumn("category_id", ids.category_id(d, category)).withColumn("model_id", ids.model_id(d, category))


def with_name(df: DataFrame, name: str, text: str, most: int = 64) -> DataFrame:
    """`df` with empty names filled by the beginning of a text."""
    return df.withColumn(name, F.when(F.trim(F.coalesce(name, F.lit(""))) == "", F.substring(F.trim(F.col(text)), 1, most)).otherwise(F.col(name)))


def with_extras(services: DataFrame, documents: DataFrame, key: str, extras: str, names: Sequence[str]) -> DataFrame:
    """`services` with named values of their document's JSON. Documents must match services one to one and hold JSON objects; else it is an error when the rows are read."""
    text = F.col("__extras")
    bad = text.isNull() | F.try_parse_json(text).isNull() | (F.substring(F.schema_of_variant(F.try_parse_json(text)), 1, 6) != "OBJECT")
    checked = F.when(bad, F.raise_error(F.concat(F.lit("no JSON object for "), F.col(key)))).otherwise(text)
    docs = documents.groupBy(F.col(key).alias("__k")).agg(F.count("*").alias("__n"), F.first(extras).alias("__extras"))
    joined = services.join(docs, F.col(key) == F.col("__k"), "left")
    joined = joined.withColumn("__extras", F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("more than one document for "), F.col(key)))).otherwise(checked))
    return joined.select(*services.columns, *(F.coalesce(F.get_json_object("__extras", f"$.{n}"), F.lit("")).alias(n) for n in names))
