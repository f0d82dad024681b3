"""Plans, retrieval, sources, sinks, schemas and streams."""

import pytest
from pyspark.sql import functions as F

from quarry.plans import hops, retrieval
from quarry.plans.variants import FLAT, LAYERED, variant
from quarry.sources import readers, schema, sinks
from quarry.streaming import streams


def plan(*steps):
    return {"hops": list(steps)}


LOCATE = {"action": "locate", "type": "事项", "query": "q", "bind": "a"}


def test_plan_checks():
    got = hops.check_plan(plan(LOCATE, {"action": "jump"}, {"action": "traverse", "from": "a", "relation": "requirematerial", "direction": "sideways"}), "question", LAYERED)
    assert got == [hops.Locate(1, "service", "q", "a"), hops.Traverse(3, "a", "requiresMaterial", "out", "n3")]
    assert hops.check_plan(plan(LOCATE), "x", FLAT)[0].type == "affair"
    for bad in ({}, plan(), plan({"action": "traverse"}), plan({"action": "locate", "type": "step"}), plan(LOCATE, {"action": "traverse", "from": "z", "relation": "partOf"}), plan(LOCATE, {"action": "traverse", "from": "a", "relation": "nope"})):
        with pytest.raises(hops.PlanError):
            hops.check_plan(bad, "x", LAYERED)
    assert len(hops.check_plan(plan(*[LOCATE] * 6), "x", LAYERED)) == 4
    with pytest.raises(hops.PlanError):
        hops.read_plan("nothing here")
    with pytest.raises(ValueError):
        variant("other")


@pytest.fixture(scope="module")
def small(spark):
    node = lambda rows: spark.createDataFrame(rows, "id string, name string")
    vec = lambda rows: spark.createDataFrame(rows, "id string, name string, vector array<float>")
    empty = spark.createDataFrame([], "id string, name string")
    nodes = {k: empty for k in LAYERED.types} | {"service": node([("s1", "one"), ("s2", "two"), ("s3", "one")]), "material": node([("m1", "card"), ("m2", "form")])}
    vectors = {"service": vec([("s1", "one", [1.0, 0.0]), ("s3", "one", [0.99, 0.1]), ("s2", "two", [0.0, 1.0])]), "material": vec([("m1", "card", [0.9, 0.1]), ("m2", "form", [0.0, 1.0])])}
    edges = spark.createDataFrame([("s1", "requiresMaterial", "m1"), ("s2", "requiresMaterial", "m1"), ("s2", "requiresMaterial", "m2")], "src string, rel string, dst string")
    return hops.Graph(LAYERED, nodes, vectors, edges)


def test_multi_hop(small):
    reply = '{"hops": [{"action": "locate", "type": "service", "bind": "a"}, {"action": "traverse", "from": "a", "relation": "所需材料", "bind": "m"}, {"action": "traverse", "from": "m", "relation": "所需材料", "direction": "in", "bind": "b"}, {"action": "traverse", "from": "a", "relation": "partOf", "bind": "c"}]}'
    run = hops.run_plan(small, reply, "q", lambda t: [1.0, 0.0])
    assert run.fallback == "" and [r.id for r in run.bound["a"][1].collect()] == ["s1"]
    assert sorted(r.id for r in run.bound["b"][1].collect()) == ["s1", "s2"]
    assert len(run.notes) == 1 and run.bound["c"][1].count() == 0
    assert [r["name"] for r in hops.services(run, LAYERED).collect()] == ["one", "two"]


def test_fallbacks(small):
    assert hops.run_plan(small, "??", "q", lambda t: [1.0, 0.0]).fallback
    reply = '{"hops": [{"action": "locate", "type": "service"}]}'
    assert hops.run_plan(small, reply, "q", lambda t: [-1.0, -1.0]).fallback == "nothing was located"
    run, found = retrieval.ask(small, "q", lambda t: [1.0, 0.0], lambda q: "broken")
    assert run.fallback and [r.id for r in found["services"].collect()] == ["s1"]
    assert retrieval.ask(small, "q", lambda t: [1.0, 0.0])[0] is None


def test_retrieve_and_render(small):
    found = retrieval.retrieve(small, "q", lambda t: [1.0, 0.0])
    assert [r.requiresMaterial for r in found["services"].collect()] == ["card"]
    assert found["extra"].count() == 0
    text = retrieval.render(found["services"], {"requiresMaterial": "材料"}).first().context
    assert text == "【one】\n材料：card"
    assert retrieval.used_by(small, "requiresMaterial", small.nodes["material"].where("id = 'm1'")).first().services == "one、two"


SCHEMA = """namespace Demo
Service(service): EntityType
    properties:
        title(title): Text
            index: TextAndVector
        count(count): Integer
        tags(tags): Text
            constraint: MultiValue
        score(score): Double
    relations:
        needs(needs): Material
Material(material): EntityType
"""


def test_schema():
    parsed = schema.parse_schema(SCHEMA)
    assert parsed["Service"].relations == {"needs": "Material"} and parsed["Service"].hints["title"] == {"index": "TextAndVector"}
    assert parsed["Service"].struct().fieldNames() == ["id", "title", "count", "tags", "score"]
    assert parsed["Service"].struct()["tags"].dataType.simpleString() == "array<string>"
    text, changed = schema.adapt_types(SCHEMA)
    assert changed == ["score(score): Double"] and "Float" in text
    assert schema.resolve(parsed, "Demo.Material", "Demo").name == "Material"
    job = {"type": "Service", "mapping": {"a": ["id", "title"], "b": "title", "c": "nope"}}
    assert schema.job_problems(parsed, job, ["a", "b"]) == ["missing column c", "mapped more than once: title", "unknown property nope"]
    assert schema.job_problems(parsed, {"relation": ("Service", "needs", "X"), "mapping": {}}, []) == ["no relation Service-needs-X"]
    assert schema.index_ids("[2, 1, 2]") == [2, 1]
    with pytest.raises(ValueError):
        schema.index_ids("[true]")


def test_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"test_id": "1", "answer": "x"}\n\nbroken\n{"test_id": "1", "answer": 5}\n{"test_id": "2", "answer": null}\n')
    assert readers.json_lines(spark, str(tmp_path / "a.jsonl"), "test_id string").count() == 3
    assert readers.json_lines(spark, str(tmp_path / "a.jsonl"), "test_id string", keep_broken=True).where("record is null").count() == 1
    assert sorted((r.test_id, r.answer) for r in readers.predictions(spark, str(tmp_path / "a.jsonl")).collect()) == [("1", "5"), ("2", "")]
    folder = tmp_path / "set1"
    folder.mkdir()
    (folder / "q.csv").write_text('﻿test_id,question\n1,"a\nb"\n2,c\n', encoding="utf-8")
    rows = readers.question_sets(spark, str(folder / "q.csv")).orderBy("test_id").collect()
    assert [(r.test_id, r.question, r.dataset) for r in rows] == [("1", "a\nb", "set1"), ("2", "c", "set1")]
    for k, text in enumerate(("test_id,question\n1, \n", "test_id,question\n", "test_id,question\n1,a\n1,b\n")):
        (folder / f"bad{k}.csv").write_text(text, encoding="utf-8")
        with pytest.raises(ValueError):
            readers.question_sets(spark, str(folder / f"bad{k}.csv"))
    with pytest.raises(ValueError):
        readers.csv_table(spark, str(folder / "q.csv"), ["none"])
    (tmp_path / "ids.txt").write_text("b\n# no\n\na\nb\n")
    assert sorted(r.id for r in readers.id_list(spark, str(tmp_path / "ids.txt")).collect()) == ["a", "b"]
    (tmp_path / "m.md").write_text("- 抽样块数：3（扫描 100 行）\n")
    assert [(r.name, r.value) for r in readers.metrics(spark, str(tmp_path / "m.md"), {"n": "抽样块数：([0-9]+)", "x": "none([0-9])"}).collect()] == [("n", "3"), ("x", None)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("f", k, "x" * 10) for k in range(5)], "file string, k int, line string")
    got = sinks.byte_parts(df, "file", "k", "line", 25).orderBy("part").collect()
    assert [(r.part, r.rows, r.bytes) for r in got] == [(1, 2, 22), (2, 2, 22), (3, 1, 11)]
    assert [r.rows for r in sinks.byte_parts(df, "file", "k", "line", 5).collect()] == [1] * 5
    sinks.write_json(df.coalesce(1), str(tmp_path / "j"), 2)
    assert len(list((tmp_path / "j").glob("*.json"))) == 3 and spark.read.json(str(tmp_path / "j")).count() == 5


def test_streams_resume(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    for k in range(2):
        events.where(f"event_id % 2 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        streams.run_to_end(streams.dedup_stream(streams.file_stream(spark, str(tmp_path / "in"), events.schema), ["event_id"], "1 day"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() <= events.count()
    seen = []
    streams.run_batches(streams.file_stream(spark, str(tmp_path / "in"), events.schema), lambda df, n: seen.append((n, df.count())), str(tmp_path / "state2"))
    assert sum(n for _, n in seen) == events.count() and len(seen) == 2
