"""The full unified record: two raw formats put into one nested structure, cleaned and hashed.

Every leaf is a text, empty where the raw record has nothing; lists keep their order and lose what is no object. A record is
declared as a table of raw keys, so that both formats are one projection each and Catalyst reads the parsed text once.

Defined cases. Text that is no JSON object, or has neither an item nor a package, has no record (null) and no kind. Repeated lines
are materialised alike. Null lines have no record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import canonical_json, clean_nested, first_filled, with_unit
from .adapt import channels, scalar

# The record's fields with the raw keys they come from, first format and second; empty where a format has none.
ITEM = (
    ("事项类型", "TASK_TYPE_TEXT", "special_item_type_text"),
    ("名称", "", ""),
    ("官方列表出现次数", "", ""),
    ("实施主体", "DEPT_NAME", "impl_org_name"),
    ("服务对象", "SERVE_TYPE_TEXT", "service_object_text"),
    ("状态", "TASK_STATE_TEXT", "status_text"),
    ("编码", "", ""),
    ("行使层级", "USE_LEVEL_TEXT", "authority_level_text"),
    ("详情返回编码", "", ""),
    ("主题分类", "", ""),
)
HANDLING = (
    ("办理地址", "", ""),
    ("办理方式", "", ""),
    ("办理深度", "WBSD_LEVEL_TEXT", "online_apply_depth_text"),
    ("办理环节", "", ""),
    ("可网上办理", "ONLINECHECK_TEXT", ""),
    ("咨询电话", "LINK_TEL", "consult_phone"),
    ("承诺办结时限", "", ""),
    ("承诺时限说明", "CRBJSXSM", "promise_time_note"),
    ("投诉电话", "TSTEL", "complaint_phone"),
    ("是否收费", "IS_FEE_TEXT", "is_charge_text"),
    ("法定办结时限", "", ""),
    ("法定时限说明", "FDBLSXSM", "legal_time_note"),
    ("窗口办理流程", "CKBLLC", "window_flow"),
    ("网上办理流程", "WSBLLC", "online_flow"),
    ("网上办理限制说明", "", ""),
    ("跨域通办", "", ""),
)
#: Fields of list elements: name, keys of the first format, keys of the second; of several keys the first that is filled counts.
STEP = (("办理人员", "TRANSACTOR", ""), ("办理时限", "TRANSACT_TIME_LIMIT", ""), ("办理结果", "TRANSACT_RESULT", ""), ("审查标准", "CHECK_STANDARD", ""), ("步骤", "STEP_TEXT", ""), ("环节", "UNTI_LINK_TEXT", ""))
RESULT = (("名称", "NAME", "name"), ("类型", "RESULT_TYPE_TEXT SUBJECT_RESULT_TYPE_TEXT", "subject_result_type_text"), ("说明", "RESUL_EXPLAIN", ""), ("有效期说明", "CARD_VALIDDATE", ""))
ANSWER = (("问题", "QUESTION", "question"), ("答复", "ANSWER", "answer"))
MATERIAL = (
    ("序号", "ORDERNUM", "sort_order"), ("名称", "MATERIAL_NAME", "document_name"), ("份数", "PAGE_NUM", "origin_count"), ("页数", "", ""), ("提交形式", "ZZHDZB_TEXT", "document_media_text"),
    ("材料类型", "MATERIAL_TYPE_TEXT", "material_type_text"), ("材料来源", "SOURCE_TYPE_TEXT", "document_source_text"), ("是否必要", "IS_NEED_TEXT", "document_need_type_text"), ("说明", "MATERIAL_DESC FILL_EXPLIAN", "note"),
)
LAW = (("名称", "LAWNAME", "legal_name"), ("文号", "ACCORDINGNUMBER", "reference_number"), ("条款", "TERMSNUMBER", "clause_number"), ("内容", "TERMSCONTENT", "content"))
FILE = (("名称", "ATTACHNAME", "name original_name"), ("公开链接", "FILEPATH", "waiwang_url"))
ONLINE = "网上办理"


def _get(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


def _is_object(v: Column) -> Column:
    return F.coalesce(F.substring(F.schema_of_variant(v), 1, 6) == "OBJECT", F.lit(False))


def _objects(v: Column, key: str) -> Column:
    """The objects in a list; what is no list has none."""
    return F.filter(F.coalesce(F.try_variant_get(v, f"$.{key}", "array<variant>"), F.array().cast("array<variant>")), _is_object)


def _field(v: Column, keys: str) -> Column:
    return first_filled(*(scalar(_get(v, k)) for k in keys.split())) if keys else F.lit("")


def _element(x: Column, fields, side: int) -> list[Column]:
    return [_field(x, f[side]).alias(f[0]) for f in fields]


def _list(v: Column, key: str, fields, side: int) -> Column:
    return F.transform(_objects(v, key), lambda x: F.struct(*_element(x, fields, side)))


def attachments(v: Column, side: int, *keys: str) -> Column:
    """Names and links of the attachments in one or more lists, one behind the other."""
    return F.concat(*(_list(v, k, FILE, side) for k in keys))


def _with_files(v: Column, key: str, fields, side: int, *files: str) -> Column:
    return F.transform(_objects(v, key), lambda x: F.struct(*_element(x, fields, side), attachments(x, side, *files).alias("公开附件")))


def _regions(v: Column, key: str, inner: str, name: str, shape: str, span: str) -> Column:
    """Regions that a service covers: distinct names in their order, joined."""
    names = lambda x: F.array_distinct(F.filter(F.transform(_objects(x, inner), lambda d: _field(d, name)), lambda n: n != ""))
    return F.transform(_objects(v, key), lambda x: F.struct(F.array_join(names(x), "、").alias("覆盖地区"), _field(x, shape).alias("通办形式"), _field(x, span).alias("通办范围")))


def _block(v: Column, fields, side: int, own: dict[str, Column]) -> Column:
    return F.struct(*((own[f[0]] if f[0] in own else _field(v, f[side])).alias(f[0]) for f in fields))


def _source(raw_sha: Column, run_id: str, line_no: Column) -> Column:
    empty = F.lit("")
    return F.struct(empty.alias("官方详情JSON"), raw_sha.alias("官方详情JSON_SHA256"), empty.alias("结构化记录_SHA256"), empty.alias("详情页URL"), F.lit(run_id).alias("运行ID"), line_no.cast("long").alias("采集序号"))


def _record(version: str, item: Column, handling: Column, results: Column, answers: Column, condition: Column, materials: Column, laws: Column, source: Column) -> Column:
    application = F.struct(condition.alias("受理条件"), materials.alias("材料"))
    return F.struct(F.lit(version).alias("schema_version"), item.alias("事项"), handling.alias("办理"), results.alias("办理结果"), answers.alias("常见问答"), application.alias("申请"), laws.alias("法律依据"), source.alias("来源"))


def unified(lines: DataFrame, line: str = "line", theme: Column | None = None, line_no: Column | None = None, version: str = "v1", run_id: str = "") -> DataFrame:
    """`lines` with kind (v1, v2, null), code, used_fallback, record (the nested structure, cleaned) and record_json (its text, with its own hash)."""
    theme = F.lit("") if theme is None else theme
    source = _source(F.sha2(F.col(line), 256), run_id, F.lit(0) if line_no is None else line_no)
    raw = F.col("__raw")
    rows = lines.withColumn("__raw", F.try_parse_json(line)).withColumn("__item", F.coalesce(F.try_variant_get(raw, "$.AUDIT_ITEM[0]", "variant"), _get(raw, "AUDIT_ITEM")))
    item = F.col("__item")
    first = _is_object(item) & (F.schema_of_variant(item) != "OBJECT<>")
    second = F.coalesce(F.array_contains(F.json_object_keys(F.col(line)), "catalog_name"), F.lit(False)) | (_field(raw, "special_item_type") == "TC")
    rows = rows.withColumn("kind", F.when(first, "v1").when(second & _is_object(raw), "v2"))
    own, window = _field(item, "ITEM_ID"), _field(F.try_variant_get(raw, "$.window_list[0]", "variant"), "address")
    lobby = _field(F.try_variant_get(raw, "$.AUDIT_CATALOG_LOBBY[0]", "variant"), "ADDRESS")
    way = _field(raw, "application_channel_text")
    days = lambda v, n, unit: with_unit(_field(v, n), _field(v, unit))
    one = F.lit(1)
    v1 = _record(
        version,
        _block(item, ITEM, 1, {"名称": _field(item, "CATANAME"), "官方列表出现次数": one, "编码": _field(item, "ITEM_ID TASK_CODE ROWGUID NATION_TASK_CODE"), "详情返回编码": _field(raw, "errCode"), "主题分类": theme}),
        _block(item, HANDLING, 1, {
            "办理地址": first_filled(_field(item, "XHTSDZ"), lobby), "办理方式": channels(_field(item, "HANDLE_TYPE_TEXT")), "办理环节": _list(raw, "AUDIT_ITEM_FLOWSHEET", STEP, 1),
            "承诺办结时限": days(item, "PROMISE_DAY", "PROMISE_TYPE_TEXT"), "法定办结时限": days(item, "ANTICIPATE_DAY", "ANTICIPATE_TYPE_TEXT"),
            "网上办理限制说明": first_filled(_field(_get(raw, "AUDIT_ITEM_EXTEND"), "UNONLINEREASON"), _field(item, "UNONLINEREASONOTHER")),
            "跨域通办": _regions(item, "SCOPES", "DIVISIONS", "DIVISION_NAME", "SCOPESHAPE_TEXT", "SCOPERANGE_TEXT"),
        }),
        _with_files(raw, "AUDIT_ITEM_RESULT", RESULT, 1, "RESULTATTACHLIST"), _list(raw, "AUDIT_QA", ANSWER, 1), _field(item, "ACCEPT_CONDITION"),
        _with_files(raw, "AUDIT_MATERIAL", MATERIAL, 1, "FORM_GUID", "EXAMPLE_GUID"), _list(item, "LAW", LAW, 1), source,
    )
    v2 = _record(
        version,
        _block(raw, ITEM, 2, {"名称": _field(raw, "catalog_name subject_name"), "官方列表出现次数": one, "编码": _field(raw, "id"), "主题分类": theme}),
        _block(raw, HANDLING, 2, {
            "办理地址": window, "办理方式": channels(way), "办理环节": F.filter(_list(raw, "AUDIT_ITEM_FLOWSHEET", STEP, 1), lambda x: F.lit(False)),
            "可网上办理": F.when(way == "", "").when(F.contains(way, F.lit(ONLINE)), "是").otherwise("否"),
            "承诺办结时限": days(raw, "promise_time", "promise_time_unit_text"), "法定办结时限": days(raw, "legal_time", "legal_time_unit_text"),
            "跨域通办": _regions(raw, "application_scope_v2_list", "division_list", "division_name", "application_shape_text", "application_scope_v2_text"),
        }),
        _with_files(raw, "result_sample_list", RESULT, 2, "sample_att_list"), _list(raw, "question_list", ANSWER, 2), _field(raw, "conditions"),
        _with_files(raw, "submit_material_list", MATERIAL, 2, "blank_att_list", "sample_att_list"), _list(raw, "clause_list", LAW, 2), source,
    )
    kept = rows.withColumn("code", F.when(F.col("kind") == "v1", _field(item, "ITEM_ID TASK_CODE ROWGUID NATION_TASK_CODE")).when(F.col("kind") == "v2", _field(raw, "id")))
    kept = kept.withColumn("used_fallback", (F.col("kind") == "v1") & (own == "") & (F.col("code") != ""))
    kept = kept.withColumn("record", F.when(F.col("kind") == "v1", v1).when(F.col("kind") == "v2", v2)).drop("__raw", "__item")
    cleaned = kept.withColumn("record", clean_nested(F.col("record"), kept.schema["record"].dataType))
    return hashed(cleaned)


def hashed(rows: DataFrame, record: str = "record") -> DataFrame:
    """`rows` with the record's hash put into it, and record_json, its text. The hash is of the record with that place empty, keys sorted."""
    blank = F.col(record).withField("`来源`.`结构化记录_SHA256`", F.lit(""))
    text = canonical_json(F.to_json(blank, {"ignoreNullFields": "false"}))
    out = rows.withColumn(record, F.when(F.col(record).isNotNull(), F.col(record).withField("`来源`.`结构化记录_SHA256`", F.sha2(text, 256))))
    return out.withColumn("record_json", F.to_json(record, {"ignoreNullFields": "false"}))


def reject_reason(line: str = "line") -> Column:
    """Why a raw line of the first format has no record: blank, bad_json, no_audit_item, missing_code_or_name, else null. Uses columns of `unified`."""
    from .validate import first_reason

    name = F.col("record")["事项"]["名称"]
    return first_reason([("blank", F.trim(F.coalesce(F.col(line), F.lit(""))) == ""), ("bad_json", F.try_parse_json(line).isNull()), ("no_audit_item", F.col("kind").isNull()), ("missing_code_or_name", (F.col("code") == "") | (name == ""))])


def template(schema: T.DataType) -> Column:
    """A record of this type with nothing in it: empty texts and lists, a count of 1."""
    if isinstance(schema, T.StructType):
        return F.struct(*(template(f.dataType).alias(f.name) for f in schema.fields))
    if isinstance(schema, T.ArrayType):
        return F.array().cast(schema)
    return F.lit("") if isinstance(schema, T.StringType) else F.lit(1).cast(schema)
