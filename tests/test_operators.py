"""Operators on small fixtures with known results."""

import json

import pytest
from pyspark.sql import functions as F

from quarry.operators import adapt, chunk, dedup, graph, profile, propositions, sample, score, state, unify, validate, vector
from quarry.queries import search


def test_json_cascade(spark):
    lines = [b'{"a": {"x": 1}, "c": "k", "n": "m"}', b"\xff\xfe", b"{bad", b"[1]", b'{"a": {}}', b'{"a": 3, "c": "k", "n": "m"}', b'{"a": {}, "c": " ", "n": ""}']
    df = spark.createDataFrame([(k, bytearray(x)) for k, x in enumerate(lines)], "k int, raw binary")
    reason = validate.json_rules("raw", ["a", "c", "n"], ["a"], {"code": "$.c", "name": "$.n"})
    assert [r.r for r in df.select("k", reason.alias("r")).orderBy("k").collect()] == [None, "invalid_utf8", "bad_json", "not_object", "missing_keys:c,n", "not_object:a", "empty:code,name"]


def test_rejects_and_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (2, "b")], "id int, x string")
    kept, rejected = validate.split_rejects(df, validate.first_reason([("empty", F.col("x") == "")]), "s1", F.col("id").cast("long"))
    assert kept.count() == 2 and rejected.first()._reject_reason == "empty" and rejected.first()._source_line == 2
    assert [(r.problem, r.value, r.n) for r in validate.key_problems(df, "id").collect()] == [("repeated", "2", 2)]
    assert validate.column_problems(df, ["id", "y"], "f") == ["f: missing column y"]


def test_disagreements(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, v string")
    b = spark.createDataFrame([(2, "z"), (3, None), (4, "w")], "id int, v string")
    assert sorted((r.id, r.problem) for r in validate.disagreements(a, b, "id", ["v"]).collect()) == [(1, "only_left"), (2, "differs"), (4, "only_right")]


def test_shared_nodes_and_rewritten_edges(spark):
    rows = spark.createDataFrame([(1, "material:a", "营业执照"), (2, "material:b", "营业执照"), (3, "material:c", "营 业 执照"), (4, "material:d", "行驶证")], "seq int, material_id string, name string")
    nodes, mapping = graph.share_nodes(rows, F.col("name"), F.replace("name", F.lit(" "), F.lit("")), "M", "material_id", "seq")
    assert sorted((r.name, r.merged) for r in nodes.collect()) == [("营业执照", 3), ("行驶证", 1)]
    edges = spark.createDataFrame([("s1", "material:a"), ("s1", "material:zzz")], "src string, dst string")
    out = {r.old: (r.dst, r.mapped) for r in graph.rewrite_edges(edges, "dst", mapping, keep="old").collect()}
    assert out["material:zzz"] == ("material:zzz", False) and out["material:a"][0].startswith("M-")


def test_citations_count_conflicts_with_the_first(spark):
    rows = spark.createDataFrame([(1, "law", "no1", "a1", "x"), (2, "law", "no1", "a1", "x"), (3, "law", "no1", "a1", "y"), (4, "law", "", "a1", "z"), (5, "law2", "no1", "a1", "x")], "seq int, law string, doc string, article string, content string")
    cited, bases = graph.citations(rows)
    assert sorted((r["name"], r.sources, r.conflicts) for r in cited.collect()) == [("law a1", 1, 0), ("law a1", 3, 1), ("law2 a1", 1, 0)]
    assert sorted((r.law, r.doc_no, r.fallbacks) for r in bases.collect()) == [("law", "law", 1), ("law", "no1", 0), ("law2", "no1", 0)]


RECORD = "seq int, code string, name string, org string, url string, affair_type string, targets string, levels string, theme string, file_stem string, count int, steps array<struct<step:string,link:string,handler:string>>, results array<struct<name:string,kind:string>>, materials array<struct<name:string,seq:string>>, laws array<struct<name:string,doc:string,article:string,content:string>>"


def test_adapt_records_to_tables(spark):
    first = (1, " C1 ", "n", "o", "u", "行政许可", "企业法人、自然人", "镇（乡、街道）级", "", "教育", 1, [("s1", "", ""), None, ("", "l3", "")], [("", "k")], [(" m ", "1"), ("", "2")], [("law", "", "a1", "x"), ("law", "", "a1", "y")])
    again = (2, "C1", "other", "o", "u", "", "", "", "", "x", 1, None, None, None, None)
    tables = graph.adapt(spark.createDataFrame([first, again], RECORD))
    affair = tables["Affair"].collect()
    assert [(r.id, r.affair_type, r.targets, r.levels, r.theme) for r in affair] == [("C1", "行政权力-行政许可", "法人-企业法人,自然人", "镇（乡、街道）级", "教育")]
    assert sorted((r.id, r["name"]) for r in tables["ProcessStep"].collect()) == [("C1#P01", "s1"), ("C1#P03", "l3")]
    assert [(r.src, r.dst) for r in tables["ProcessStep_nextStep_ProcessStep"].collect()] == [("C1#P01", "C1#P03")]
    assert [r["name"] for r in tables["ResultDocument"].collect()] == ["办理结果1"]
    assert [r.dst for r in tables["Affair_requireMaterial_Material"].collect()] == ["m"]
    assert tables["LegalCitation"].count() == 1 and tables["Affair_citeLegal_LegalCitation"].count() == 2
    assert {r.kind for r in tables["Concept"].collect()} == {"ServiceTarget", "AffairType", "ExerciseLevel", "ThemeCategory"}


def test_materialise_both_formats(spark):
    v1 = {"AUDIT_ITEM": [{"ITEM_ID": "", "TASK_CODE": "T1", "CATANAME": "N", "PROMISE_DAY": 5, "PROMISE_TYPE_TEXT": "工作日", "HANDLE_TYPE_TEXT": "a, b,", "LAW": [{"LAWNAME": "L"}, 3]}], "AUDIT_CATALOG_LOBBY": [{"ADDRESS": "addr"}], "AUDIT_ITEM_FLOWSHEET": [{"STEP_TEXT": "s"}]}
    v2 = {"id": "P1", "special_item_type": "TC", "catalog_name": "", "subject_name": "S", "application_channel_text": "网上办理,窗口", "submit_material_list": [{"document_name": "d", "sort_order": 2}]}
    rows = spark.createDataFrame([(json.dumps(x),) for x in (v1, v2, {"x": 1})], "line string")
    got = {r.variant: r for r in adapt.materialise(rows).collect()}
    assert (got["v1"].code, got["v1"].address, got["v1"].promise, got["v1"].channels, [x["name"] for x in got["v1"].laws], got["v1"].steps[0].step) == ("T1", "addr", "5个工作日", ["a", "b"], ["L"], "s")
    assert (got["v2"].code, got["v2"]["name"], got["v2"].online, [(m.name, m.seq) for m in got["v2"].materials]) == ("P1", "S", "是", [("d", "2")])
    assert got[None].code is None


def test_extras_must_match(spark):
    services = spark.createDataFrame([("s1", "n")], "service_id string, name string")
    docs = spark.createDataFrame([("s1", '{"service_object":"自然人","official_list_count":2}')], "service_id string, extras_json string")
    out = adapt.with_extras(services, docs, "service_id", "extras_json", ["service_object", "official_list_count", "none"]).first()
    assert (out.service_object, out.official_list_count, out.none) == ("自然人", "2", "")
    with pytest.raises(Exception, match="no JSON object"):
        adapt.with_extras(services, docs.where("service_id = 'x'"), "service_id", "extras_json", ["a"]).collect()


def test_merge_sources(spark):
    left = spark.createDataFrame([("DUP-P", "long record", ""), ("ONLY-P", "x", "t")], "code string, body string, topic string")
    right = spark.createDataFrame([("DUP-P", "short", "topic"), ("ONLY-L", "y", "")], "code string, body string, topic string")
    out = {r.code: r for r in unify.merge_sources(left, right, "code", F.length("body"), "topic", ("personal", "legal")).collect()}
    assert (out["DUP-P"].body, out["DUP-P"].topic, out["DUP-P"].sources) == ("long record", "topic", ["personal", "legal"])
    assert out["ONLY-L"].sources == ["legal"] and out["ONLY-P"].topic == "t"
    nested = spark.sql("select struct('a' as x, 'b' as y) as m")
    assert unify.put_field(nested, "m", "z", F.lit("c"), "x").schema["m"].dataType.fieldNames() == ["x", "z", "y"]


@pytest.mark.parametrize("limit,overlap", [(20, 5), (50, 0), (200, 40)])
def test_chunks_are_bounded_and_cover(limit, overlap):
    text = "\n\n".join(["一二三。四五六！" * 5, "short", "x" * 130, "a;b?c。" * 9])
    got = chunk.split_text(text, limit, overlap)
    assert all(0 < len(c) <= limit for c in got)
    if not overlap:
        squash = lambda s: "".join(s.split())
        assert squash("".join(got)) == squash(text)
    assert chunk.split_text("", limit, overlap) == []


def test_chunk_rows(spark):
    df = spark.createDataFrame([("d1", "T", "a" * 30), (" ", "x", "b"), ("d2", "", None)], "doc_id string, title string, content string")
    got = chunk.chunk_documents(df, "doc_id", "content", "title", 10, 0).orderBy("chunk_no").collect()
    assert [(r.chunk_id, r.title) for r in got] == [("d1#chunk:0001", "T（第1/3段）"), ("d1#chunk:0002", "T（第2/3段）"), ("d1#chunk:0003", "T（第3/3段）")]


def test_quotas_add_up():
    for sizes, limit in (({"a": 100, "b": 3, "c": 1}, 10), ({"a": 5, "b": 5}, 3), ({"a": 1}, 9), ({k: 1 for k in "abcdef"}, 4)):
        quota = sample.fit_quotas(sizes, limit)
        assert sum(quota.values()) == min(limit, sum(sizes.values())) and all(0 <= quota[k] <= sizes[k] for k in sizes)


def test_propositions(spark):
    reply = "```json\n" + json.dumps([
        {"predicate": "资格要求", "statement": "年满十八周岁的中国公民可申请", "conditionType": "资格要求", "objectValue": " v "},
        {"predicate": "bad", "statement": "需要携带本人身份证原件办理", "conditionType": "bad"},
        {"predicate": "其他", "statement": "太短"},
        {"predicate": "其他", "statement": "需要携带本人身份证原件办理"},
    ], ensure_ascii=False) + "\n```"
    replies = spark.createDataFrame([("c1", reply, "condition"), ("c2", "none", "fee")], "k string, reply string, field string")
    kept, counts = propositions.parse(replies, "k", "reply", "field")
    assert [(r.seq, r.predicate, r.condition_type, r.object_value) for r in kept.orderBy("seq").collect()] == [(0, "资格要求", "资格要求", "v"), (1, "其他", "", "")]
    c = counts.first()
    assert (c.raw, c.invalid_predicate, c.bad_statement, c.duplicate, c.invalid_condition_type, c.kept) == (4, 1, 1, 1, 1, 2)
    fields = spark.createDataFrame([("办理流程：x 办理条件：y",), ("收费标准：z",), ("",)], "c string")
    assert [r.f for r in fields.select(propositions.source_field(F.col("c")).alias("f")).collect()] == ["condition", "fee", "other"]


def test_propositions_of_whole_texts(spark, tmp_path):
    text = " ".join(f"Sentence number {k % 7} stands here." for k in range(12))
    spark.createDataFrame([(1, text), (2, text), (5, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.key: (r.raw, r.kept, r.duplicate) for r in search.proposition_parse(spark, str(tmp_path)).collect()}
    assert got == {1: (12, 7, 5), 2: (12, 7, 5)}


def test_ask_retries(spark):
    def client():
        seen = {}

        def call(text):
            seen[text] = seen.get(text, 0) + 1
            if text == "flaky" and seen[text] == 1:
                raise TimeoutError("slow")
            if text == "bad":
                raise ValueError("no")
            return text.upper()

        return call

    df = spark.createDataFrame([("flaky",), ("bad",), ("ok",)], "p string").coalesce(1)
    got = {r.p: (r.reply, r.error) for r in propositions.ask(df, "p", client).collect()}
    assert got == {"flaky": ("FLAKY", None), "bad": (None, "ValueError: no"), "ok": ("OK", None)}


def test_scores(spark):
    gold = spark.createDataFrame([("X1", "d", "t", "材料：Ａ"), ("X2", "d", "t", "b"), ("X3", "d", "u", "c")], "test_id string, dataset string, answer_type string, expected_answer string")
    answers = spark.createDataFrame([("X1", "材料:A"), ("X2", " ")], "test_id string, answer string")
    scored = score.score_answers(gold, answers)
    assert sorted((r.test_id, r.em, r.answered) for r in scored.collect()) == [("X1", 1, True), ("X2", 0, False), ("X3", 0, False)]
    assert {(r.level, r.n): r.em for r in score.summarise(scored).collect()}[("all", 3)] == round(1 / 3, 6)


def test_states(spark):
    parts = spark.createDataFrame([("j", 1, "UPLOADED"), ("j", 1, "SUCCESS"), ("j", 2, "UPLOADING"), ("k", 1, "SUBMITTED")], "job string, part int, state string")
    assert sorted((r.job, r.part, r.state) for r in state.merged(parts, ["job", "part"]).collect()) == [("j", 1, "SUCCESS"), ("j", 2, "UPLOADING"), ("k", 1, "SUBMITTED")]
    truth = spark.createDataFrame([("j", 2, "FAILURE"), ("k", 1, "FINISH")], "job string, part int, status string")
    fixed = state.repaired(state.merged(parts, ["job", "part"]).select("job", "part", "state"), truth, ["job", "part"])
    assert sorted((r.job, r.part, r.state) for r in fixed.collect()) == [("j", 1, "SUCCESS"), ("k", 1, "SUCCESS")]


def test_embedding(spark):
    df = spark.createDataFrame([(1, "alpha beta"), (2, "bad"), (3, None)], "id int, t string").coalesce(1)
    stub = vector.hashing_embedder(8)

    def embed(texts):
        if "bad" in texts and len(texts) > 1:
            raise RuntimeError
        return [[0.0] if t == "bad" else v for t, v in zip(texts, stub(texts))]

    got = {r.id: r.v for r in vector.embed_column(df, "t", "v", embed, 8).collect()}
    assert got[2] is None and len(got[1]) == 8 and got[3] == [0.0] * 8
    assert vector.vector_property("checkStandard") == "_check_standard_vector"


def test_upsert_keeps_the_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, seq int, v string")
    assert sorted((r.k, r.v) for r in dedup.last_wins(df, ["k"], ["seq"]).collect()) == [("a", "y"), ("b", "z")]


def test_code_text_pairs_keep_totals_and_first_texts(spark):
    rows = [("a", t) for t in "gfedcba"] + [("a", "a"), ("b", None), ("b", None), ("", "x"), (None, "y"), ("c", ""), ("c", None)]
    got = profile.code_text_pairs(spark.createDataFrame(rows, "code string, text string"), "code", "text", 3).collect()
    assert {tuple(r) for r in got} == {("a", 7, 8, "a;b;c"), ("b", 1, 2, ""), ("c", 2, 2, "")}
    assert profile.code_text_pairs(spark.createDataFrame([], "code string, text string"), "code", "text").count() == 0
