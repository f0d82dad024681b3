"""Full records of both raw formats against records written by hand."""

import hashlib
import json

from pyspark.sql import functions as F
from quarry.operators import records

V1 = {
    "errCode": 0,
    "AUDIT_ITEM": [{"ITEM_ID": "", "TASK_CODE": "T1", "CATANAME": "  建房&lt;br&gt;许可 ", "DEPT_NAME": "局", "IS_FEE_TEXT": False, "HANDLE_TYPE_TEXT": "窗口, 网上,", "PROMISE_DAY": 5, "PROMISE_TYPE_TEXT": "工作日", "ANTICIPATE_DAY": "3个月", "ANTICIPATE_TYPE_TEXT": "月", "ACCEPT_CONDITION": "a\tb",
                    "SCOPES": [{"DIVISIONS": [{"DIVISION_NAME": "甲"}, {"DIVISION_NAME": "乙"}, {"DIVISION_NAME": "甲"}, 7], "SCOPESHAPE_TEXT": "全程"}, "x"], "LAW": [{"LAWNAME": "法", "TERMSNUMBER": 3}], "UNONLINEREASONOTHER": "无"}],
    "AUDIT_ITEM_EXTEND": [],
    "AUDIT_CATALOG_LOBBY": [{"ADDRESS": "路1号"}],
    "AUDIT_ITEM_FLOWSHEET": [{"STEP_TEXT": "受理", "TRANSACTOR": "人"}, None],
    "AUDIT_ITEM_RESULT": [{"NAME": "证", "SUBJECT_RESULT_TYPE_TEXT": "证照", "RESULTATTACHLIST": [{"ATTACHNAME": "样", "FILEPATH": "http://x"}, "no"]}],
    "AUDIT_QA": [{"QUESTION": "q", "ANSWER": "a"}],
    "AUDIT_MATERIAL": [{"ORDERNUM": 1, "MATERIAL_NAME": "表", "FILL_EXPLIAN": "说", "FORM_GUID": [{"ATTACHNAME": "f"}], "EXAMPLE_GUID": [{"ATTACHNAME": "e"}]}],
}
V2 = {
    "id": 9, "catalog_name": "", "subject_name": "套餐", "special_item_type": "TC", "application_channel_text": "网上办理,窗口办理", "promise_time": 2, "promise_time_unit_text": "天", "window_list": [{"address": "厅"}],
    "application_scope_v2_list": [{"division_list": [{"division_name": "丙"}], "application_scope_v2_text": "省"}], "result_sample_list": [{"name": "n", "sample_att_list": [{"original_name": "o", "waiwang_url": "u"}]}],
    "submit_material_list": [{"sort_order": 2, "document_name": "d", "blank_att_list": [{"name": "b"}], "sample_att_list": [{"name": "s"}]}], "clause_list": [{"legal_name": "l", "content": "c"}], "question_list": [{"question": "q2"}], "conditions": "cond",
}


def test_records_of_both_formats(spark):
    texts = [json.dumps(V1, ensure_ascii=False), json.dumps(V2, ensure_ascii=False), "", "{", '{"AUDIT_ITEM": []}', '{"AUDIT_ITEM": {"CATANAME": "x"}}', None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, line string")
    made = records.unified(df, theme=F.lit("主题"), line_no=F.col("k"), run_id="r").withColumn("why", records.reject_reason())
    got = {r.k: r for r in made.collect()}
    assert [got[k].kind for k in range(7)] == ["v1", "v2", None, None, None, "v1", None]
    assert [got[k].why for k in range(7)] == [None, None, "blank", "bad_json", "no_audit_item", "missing_code_or_name", "blank"]
    a, b = json.loads(got[0].record_json), json.loads(got[1].record_json)
    assert got[0].code == "T1" and got[0].used_fallback and not got[1].used_fallback
    assert a["事项"] == {"事项类型": "", "名称": "建房\n许可", "官方列表出现次数": 1, "实施主体": "局", "服务对象": "", "状态": "", "编码": "T1", "行使层级": "", "详情返回编码": "0", "主题分类": "主题"}
    assert a["办理"]["办理方式"] == ["窗口", "网上"] and a["办理"]["办理地址"] == "路1号" and a["办理"]["承诺办结时限"] == "5个工作日" and a["办理"]["法定办结时限"] == "3个月" and a["办理"]["是否收费"] == "否"
    assert a["办理"]["办理环节"] == [{"办理人员": "人", "办理时限": "", "办理结果": "", "审查标准": "", "步骤": "受理", "环节": ""}] and a["办理"]["网上办理限制说明"] == "无"
    assert a["办理"]["跨域通办"] == [{"覆盖地区": "甲、乙", "通办形式": "全程", "通办范围": ""}]
    assert a["办理结果"] == [{"名称": "证", "类型": "证照", "说明": "", "有效期说明": "", "公开附件": [{"名称": "样", "公开链接": "http://x"}]}]
    assert a["申请"]["受理条件"] == "a b" and [f["名称"] for f in a["申请"]["材料"][0]["公开附件"]] == ["f", "e"] and a["申请"]["材料"][0]["说明"] == "说"
    assert a["法律依据"] == [{"名称": "法", "文号": "", "条款": "3", "内容": ""}] and a["常见问答"] == [{"问题": "q", "答复": "a"}]
    assert b["事项"]["名称"] == "套餐" and b["事项"]["编码"] == "9" and b["办理"]["可网上办理"] == "是" and b["办理"]["办理环节"] == [] and b["办理"]["承诺办结时限"] == "2个天"
    assert b["办理结果"][0]["公开附件"] == [{"名称": "o", "公开链接": "u"}] and b["申请"]["受理条件"] == "cond" and b["办理"]["跨域通办"][0]["覆盖地区"] == "丙"
    for text, rec in zip(texts, (a, b)):
        own = rec["来源"].pop("结构化记录_SHA256")
        assert rec["来源"]["官方详情JSON_SHA256"] == hashlib.sha256(text.encode()).hexdigest() and rec["来源"]["运行ID"] == "r"
        rec["来源"]["结构化记录_SHA256"] = ""
        assert own == hashlib.sha256(json.dumps(rec, ensure_ascii=False, sort_keys=True).encode()).hexdigest()


def test_template(spark):
    kind = records.unified(spark.createDataFrame([("{}",)], "line string")).schema["record"].dataType
    row = spark.range(1).select(records.template(kind).alias("r")).first().r
    assert row["事项"]["名称"] == "" and row["办理结果"] == [] and row["事项"]["官方列表出现次数"] == 1
