"""Context of services, one-shot retrieval, routing tables, part files and the small operators, on tables made by hand."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import ids, register_all, text
from quarry.operators import dedup, graph, propositions, validate
from quarry.plans import context, hops
from quarry.plans.variants import LAYERED
from quarry.sources import jobs, readers, sinks


@pytest.fixture(scope="module")
def small(spark):
    """Two services; s1 has materials, two steps, two citations of one basis, chunks of three kinds."""
    node = lambda rows, extra="": spark.createDataFrame(rows, f"id string, name string{extra}")
    nodes = {k: node([]) for k in LAYERED.types} | {
        "service": node([("s1", "License"), ("s2", "License"), ("s3", "Permit")]),
        "material": node([("m1", '"form"'), ("m2", "form"), ("m3", "map"), ("m4", "photo")]),
        "step": node([("p1", "receive", "1d"), ("p2", "decide", None)], ", time_limit string"),
        "citation": node([("c1", "c one", "art 1", "x" * 500), ("c2", "c two", "art 2", "y"), ("c3", "c three", "art 2", "z")], ", article string, content string"),
        "basis": node([("b1", "Law", "no 1"), ("b2", "Act", "no 2")], ", doc_no string"),
        "chunk": node([(f"k{k}", "n", field, words) for k, (field, words) in enumerate([("acceptCondition", "one"), ("acceptCondition", "two"), ("faq", "three"), (None, "four"), ("windowProcess", "")])], ", source_field string, content string"),
        "faq": node([("f1", "why?", "so")], ", answer string"),
    }
    edges = [("s1", "requiresMaterial", "m1", None), ("s1", "requiresMaterial", "m2", None), ("s1", "requiresMaterial", "m3", 1), ("s1", "hasProcessStep", "p2", 2), ("s1", "hasProcessStep", "p1", 1), ("s1", "citesLegal", "c1", None), ("c1", "partOf", "b1", None), ("c2", "partOf", "b2", None), ("c3", "partOf", "b2", None), ("s1", "hasFaq", "f1", 1)]
    edges += [("s1", "hasChunk", f"k{k}", k) for k in range(5)]
    vectors = {"service": [("s1", "License", [1.0, 0.0]), ("s2", "License", [0.99, 0.1]), ("s3", "Permit", [0.9, 0.3])], "material": [("m3", "map", [1.0, 0.1]), ("m4", "photo", [1.0, 0.2])], "citation": [("c1", "c one", [1.0, 0.0]), ("c2", "c two", [1.0, 0.1]), ("c3", "c three", [1.0, 0.2])], "basis": [("b2", "Act", [1.0, 0.0]), ("b1", "Law", [0.8, 0.6])]}
    frames = {k: spark.createDataFrame(v, "id string, name string, vector array<double>") for k, v in vectors.items()}
    return hops.Graph(LAYERED, nodes, frames, spark.createDataFrame(edges, "src string, rel string, dst string, order_no int"))


def test_service_context(spark, small):
    chosen = spark.createDataFrame([("s1", "License"), ("s3", "Permit")], "id string, name string")
    got = {r.id: r for r in context.service_context(small, chosen).collect()}
    a, b = got["s1"], got["s3"]
    assert [m.name for m in a.materials] == ["map", "form"] and [(s.number, s.name, s.time_limit) for s in a.steps] == [("1", "receive", "1d"), ("2", "decide", "")]
    assert [(c.citation_id, c.article, c.basis, c.doc_no, len(c.content)) for c in a.citations] == [("c1", "art 1", "Law", "no 1", 401)]
    assert a.acceptCondition == "one two" and a.windowProcess == "" and [(c.source_field, c.content) for c in a.chunks] == [("faq", "three"), ("", "four")]
    assert [(f.question, f.answer) for f in a.faqs] == [("why?", "so")] and (b.materials, b.steps, b.chunks, b.acceptCondition) == ([], [], [], "")


@pytest.mark.parametrize("shared_ids, expected", [(True, ["c2", "c3"]), (False, ["c2"])])
def test_retrieval_adds_what_is_not_covered(small, shared_ids, expected):
    got = context.retrieve_context(small, "q", lambda q: [1.0, 0.0], shared_ids=shared_ids)
    assert sorted(r.id for r in got["services"].collect()) == ["s1", "s3"]
    assert [r.id for r in got["materials"].collect()] == ["m4"]
    assert sorted(r.id for r in got["citations"].collect()) == expected  # Act is covered by c2, Law by the service


def test_routing_tables(spark):
    rows = spark.createDataFrame([("1", " 户政 "), ("2", None), ("3", "户政"), (" ", "税务")], "service_id string, category_l2 string")
    got = graph.routing_tables(rows, "legal", "法人", "scheme:legal", ["A"], ["r"])
    assert {k: v.count() for k, v in got.items()} == {"service_domains": 1, "category_schemes": 1, "service_categories": 4, "knowledge_models": 4, "category_parent": 3, "category_belongs_to_scheme": 4, "category_belongs_to_domain": 4, "model_applies_to_category": 3, "model_belongs_to_domain": 4, "model_extends_model": 3, "service_belongs_to_domain": 3, "service_classified_as": 3, "service_uses_model": 3}
    child = got["knowledge_models"].where("category_id = 'category:legal:户政'").first()
    assert json.loads(child.retrieval_filter) == {"domain_id": "legal", "category_id": "category:legal:户政"} and child.name == "法人-户政知识模型"
    with pytest.raises(ValueError):
        graph.routing_tables(spark.createDataFrame([("1", "a b"), ("2", "a_b")], "service_id string, category_l2 string"), "d", "n", "s", [], [])


def test_part_files(spark, tmp_path):
    rows = [("f", k, 'a "q", b' if k == 3 else "x" * (k % 4), None) for k in range(50)] + [("g", 0, "y" * 300, "z")]
    df = spark.createDataFrame(rows, "file string, k int, t string, n string")
    got = {(r.file, r.part): r for r in sinks.write_parts(df, f"file://{tmp_path}/out", "file", "k", 60, 7).collect()}
    back = []
    for (_, _), r in sorted(got.items()):
        raw = (tmp_path / "out" / r.path).read_bytes()
        assert raw.startswith(b"\xef\xbb\xbfk,t,n\n") and hashlib.sha256(raw).hexdigest() == r.sha256 and len(raw) == r.bytes and (len(raw) <= 60 or r.rows == 1) and r.rows <= 7
        back.append(r.rows)
    assert sum(back) == 51 and len(list((tmp_path / "out").iterdir())) == len(got)
    read = readers.csv_table(spark, f"{tmp_path}/out/f.part-*.csv")
    assert read.count() == 50 and read.where("k = 3").first().t == 'a "q", b'
    with pytest.raises(ValueError):
        sinks.write_parts(df, f"file://{tmp_path}/no", "file", "k", 5)


def test_chunk_parts(spark, tmp_path):
    docs = spark.createDataFrame([(f"d{k}", "t", "第一句。" * 120) for k in range(4)], "doc_id string, title string, content string")
    got = sinks.write_chunks(docs, f"file://{tmp_path}/c", 3000, limit=200, overlap=0).collect()
    assert sum(r.rows for r in got) == readers.csv_table(spark, f"{tmp_path}/c").count() > 4 and all(r.counted >= 1 for r in got) and sum(r.counted for r in got) >= 4


def test_a_folder_stays_until_the_new_one_is_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_json(spark.range(3), path)
    with pytest.raises(Exception):
        sinks.write_json(spark.range(3).select(F.raise_error(F.lit("no")).alias("x")), path)
    assert spark.read.json(path).count() == 3
    sinks.write_json(spark.range(5), path)
    assert spark.read.json(path).count() == 5 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]
    assert sinks.rows_by_file(spark, path).agg(F.sum("rows")).first()[0] == 5


def test_small_operators(spark):
    df = spark.createDataFrame([("a", " " + "x" * 30 + " "), ("", "x" * 40), ("b", "x" * 29), ("c", None)], "id string, t string")
    assert [r.id for r in df.where(validate.long_enough("t", "id")).collect()] == ["a"]
    assert tuple(validate.oversize(df, "t", 31).first()) == (4, 2)
    left, right = spark.createDataFrame([(0, "a", 1), (1, "b", 2)], "p int, k string, x int"), spark.createDataFrame([(1, "b", 20), (0, "a", 10)], "p int, k string, y int")
    assert sorted(tuple(r) for r in validate.zip_rows(left, right, "p", "k").collect()) == [(0, "a", 1, 10), (1, "b", 2, 20)]
    for bad in (right.where("p = 0"), right.withColumn("k", F.lit("z")), right.unionByName(right)):
        with pytest.raises(Exception):
            validate.zip_rows(left, bad, "p", "k").collect()
    rows = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z")], "k string, o int, v string")
    assert {r.k: [x.v for x in r.rows] for r in dedup.group_in_order(rows, "k", "o").collect()} == {"a": ["x", "y"], "b": ["z"]}
    assert {r.k: [x.v for x in r.rows] for r in dedup.group_in_order(rows, "k", "o", 1).collect()} == {"a": ["x"], "b": ["z"]}
    quoted = spark.createDataFrame([('a, "b, c" ,,"d"',), ("",)], "t string").select(text.split_quoted("t").alias("f")).collect()
    assert [r.f for r in quoted] == [["a", "b, c", "", "d"], [""]]
    one = spark.createDataFrame([(True, [1, 2], " x ", None)], "a boolean, b array<int>, c string, d int")
    assert tuple(one.select(*(text.one_line(f.name, f.dataType) for f in one.schema.fields)).first()) == ("true", "[1,2]", "x", "")
    assert isinstance(one.schema["b"].dataType, T.ArrayType)
    assert register_all(spark) and spark.sql("""select canonical('Ａ b') as c, json_length('{"a": 1}') as n, json_length('{') as x""").first()[:] == ("ab", 8, None)
    assert readers.ad_hoc("select count(*) as n from {t} where k = 'a'", t=rows).first().n == 2 and readers.table_count(rows, "k").first().n == 2
    bags = spark.createDataFrame([(["a", "b", "a"], ["a", "a", "c", "ab"])], "x array<string>, y array<string>")
    assert bags.select(text.bag_f1(F.col("x"), F.col("y"))).first()[0] == pytest.approx(4 / 7)


def test_file_digests(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"abc")
    got = ids.file_digests(spark, str(tmp_path / "x")).first()
    assert (got.bytes, got.sha256) == (3, hashlib.sha256(b"abc").hexdigest())


def test_calls_are_tried_again_and_bounded():
    seen = []

    def call(text):
        seen.append(text)
        if text == "busy" and seen.count("busy") < 3:
            raise propositions.Refused(503)
        if text == "bad":
            raise propositions.Refused(400)
        return "[]" if text != "shape" else "no"

    assert propositions.tried(call, "busy", 2, 0, None) == ("[]", None)
    assert propositions.tried(call, "bad", 3, 0, None)[0] is None and seen.count("bad") == 1
    assert propositions.tried(call, "shape", 1, 0, lambda r: r.startswith("["))[1] and seen.count("shape") == 2
    begun, most = [], [0]
    got = list(propositions.in_flight(lambda t: (begun.append(t), t)[1:], (most.__setitem__(0, max(most[0], k - len(begun))) or k for k in range(50)), 3))
    assert [t for (t,) in got] == list(range(50)) and most[0] <= 6


def test_calls_of_many_threads_keep_their_order(spark):
    df = spark.createDataFrame([(k, f"t{k}") for k in range(40)], "k int, p string")
    got = propositions.ask(df, "p", lambda: lambda t: t.upper(), workers=4).collect()
    assert all(r.reply == f"T{r.k}" and r.error is None for r in got) and len(got) == 40


def test_lanes_sweeps_and_watchdog(spark):
    listed = [jobs.Job(f"j{k}", g, "", {}, type="T", index_ids=[1]) for k, g in enumerate(["entities", "concepts", "entities", "entities", "chunks"])]
    assert [[j.key for j in lane] for lane in jobs.lanes(listed, {"j2"}, 2)] == [["j1"], ["j0"], ["j3"], ["j4"]]
    tries = []
    run = lambda j: (tries.append(j.key), j.key != "j3" or tries.count("j3") > 1)[1]
    assert jobs.supervise(listed, run, set()) == ({"j0", "j1", "j2", "j3", "j4"}, [])
    assert jobs.supervise(listed, lambda j: j.key != "j0", set(), sweeps=1) == ({"j1", "j2", "j3"}, ["j0"])
    dog = jobs.Watchdog(600, 1800, 2)
    assert [dog.due(s, t) for s, t in ((-1, 0), (500, 0), (700, 0), (700, 1000), (700, 2000), (700, 9000), (700, 86_401))] == [False, False, True, False, True, False, True]
    running = spark.createDataFrame([("Closing", "PT1M2.5S"), ("Running", "PT9H")], "status string, elapsed string")
    assert jobs.longest_running(running).first().seconds == 62.5
