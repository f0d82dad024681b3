"""Question sets, reports, expectations and jobs."""

import json

import pytest
from pyspark.sql import functions as F

from quarry.operators import report, testset
from quarry.sources import jobs

CANDIDATE = f"service_id string, name string, category_l1 string, category_l2 string, department_name string, source_url string, anchor string, items array<{testset.ITEM}>"


def item(name, order=None, required=None, role=None, answer=None):
    return (name, order, required, role, answer)


def one(spark, kind, items, name="居住证申领服务", anchor=""):
    rows = testset.questions(spark.createDataFrame([("s1", name, "c", "", "", "", anchor, items)], CANDIDATE), kind).collect()
    return rows[0] if rows else None


def test_question_kinds(spark):
    r = one(spark, "material", [item("表", "10"), item("证", "2", "否"), item(" ", "1"), item("照", "x")])
    assert (r.question, r.expected_answer, r.answer_type) == ("居住证申领服务需要提交哪些申请材料？", "必要申请材料：\n1. 证（非必要）\n2. 表（必要）\n3. 照（必要）", "materials")
    assert one(spark, "department", [item("b", role="协同"), item("a", role="主管部门"), item("b", role="协同")]).expected_answer == "办理部门：a、b"
    assert one(spark, "faq", [item("q2", "2", answer="x\n y"), item("q1", "1", answer="z"), item("q3", "3", answer="w")]).expected_answer == "常见问题：\n1. 问：q1\n答：z\n2. 问：q2\n答：x y"
    hop = one(spark, "multi_hop_dept", [item("t1"), item("t2"), item("t2"), item("t3")], anchor="公安局")
    assert hop.question == "除居住证申领服务外，公安局还负责办理哪些事项？" and hop.department_name == "公安局" and hop.expected_answer.endswith("3. t3")
    assert one(spark, "multi_hop_dept", [item("t1"), item("t2")], anchor="a") is None
    assert one(spark, "legal", [item("x")], name="短") is None and one(spark, "legal", []) is None and one(spark, "legal", [item("x" * 900)]) is None


def test_set_takes_turns(spark):
    rows = [(f"s{k}", f"服务名称编号{k:03d}", f"c{k % 3}", "", "d", "", "", [item("x")]) for k in range(30)]
    df = spark.createDataFrame(rows, CANDIDATE)
    got = testset.build({"legal": df, "condition": df}, 6).collect()
    assert len(got) == 12 and sorted(r.test_id for r in got) == [f"MH{k:03d}" for k in range(1, 13)]
    assert {r.category_l1: sum(x.category_l1 == r.category_l1 for x in got) for r in got} == {"c0": 4, "c1": 4, "c2": 4}
    assert [r.n for r in testset.volumes(df).collect()] == [10, 10, 10]


def test_reports(spark):
    df = spark.createDataFrame([("a|b", 1), (None, 2)], "x string, n int")
    assert report.markdown(df, 1) == "| x | n |\n|---|---|\n| a\\|b | 1 |\n(the first 1 rows)"
    assert report.sections({"T": "text"}) == "## T\n\ntext\n" and json.loads(report.as_json({"t": df}))["t"][1]["n"] == 2
    nodes = report.expected_nodes({"Given": 5, "Own": (spark.createDataFrame([(" a",), ("a",), ("",), (None,)], "i string"), "i")})
    assert sorted((r.type, r.n) for r in nodes.collect()) == [("Given", 5), ("Own", 1)]
    edges = report.expected_edges({"e": (spark.createDataFrame([("a", "b"), ("a", "b "), ("a", "")], "s string, o string"), "s", "o")})
    assert [r.n for r in edges.collect()] == [1]


def test_runs_compared(spark):
    kind = "chunk_id string, predicate string, statement string, seq int"
    a = spark.createDataFrame([("c1", "p", "s", 1), ("c1", "p", "s", 2), ("c2", "q", "t", 1)], kind)
    b = spark.createDataFrame([("c1", "p", "s", 1), ("c3", "p", "u", 1)], kind)
    out = report.compare_runs(a, b)
    assert tuple(out["statements"].first()) == (1, 2, 1)
    assert {r.side: r.blocks for r in out["blocks"].collect()} == {"both": 1, "left": 1, "right": 1}
    assert {r.predicate: r["diff"] for r in out["values"].collect()} == {"p": 0, "q": 1}


def test_jobs(spark):
    text = json.dumps([{"key": "r", "group": "relations", "path": "r.csv", "mapping": {"a": "s"}, "relation": ["A", "to", "B"]}, {"key": "e", "group": "entities", "path": "e.csv", "mapping": {"a": ["id", "code"], "b": []}, "type": "A"}])
    listed = jobs.read_jobs(text)
    assert [j.key for j in listed] == ["e", "r"] and jobs.select(listed, ["r"])[0].key == "r"
    table = spark.createDataFrame([("1", "x"), ("2", "y")], "a string, b string")
    assert jobs.payload(listed[0], table).columns == ["id", "code"]
    first = jobs.content_key(listed[0], table)
    assert first.first() == jobs.content_key(listed[0], table.orderBy(F.desc("a"))).first()
    other = jobs.content_key(listed[0], table.where("a = '1'"))
    assert jobs.left_to_do(first.unionByName(other), first).count() == 1
    with pytest.raises(ValueError, match="chunks need index ids"):
        jobs.read_jobs(json.dumps([{"key": "c", "group": "chunks", "path": "c", "mapping": {}, "type": "C"}]))
    with pytest.raises(KeyError):
        jobs.select(listed, ["none"])
