"""Duplicates, neighbours, mixing, sharding and the pipeline: against brute force, with odd rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import same
from quarry.llm import components, exact_dedup, mixing, near_dedup, neighbours, queries, sharding
from test_text_operators import ODD, SCHEMA, odd  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf, name):
    same(queries.queries()[name](spark, sf), queries.oracle_sql()[name], sf)


def test_exact_copies(spark):
    rows = [(k, f"text {k % 40}" if k % 3 else f"TEXT {k % 40}") for k in range(300)] + [(900, None), (901, ""), (902, "Ä"), (903, "ä"), (904, "a"), (904, "a"), (None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    groups = {}
    for k, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(k)
    got = exact_dedup.find_copies(df).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)
    for r in got:
        group = next(g for g in groups.values() if r.doc_id in g)
        assert (r.keep_id, r.group_size) == (max(group, key=lambda x: -1 if x is None else x), len(group))
    stay = exact_dedup.drop_copies(df).collect()
    assert len(stay) == len(groups) and {r.doc_id for r in stay} == {max(g, key=lambda x: -1 if x is None else x) for g in groups.values()}


def test_exact_copies_with_few_bits(spark):
    df = spark.createDataFrame([(k, f"t{k % 500}") for k in range(800)], "doc_id long, text string")
    got = exact_dedup.find_copies(df, max_bits=1 << 10).collect()
    assert sum(r.kept for r in got) == 500 and {r.group_size for r in got} == {1, 2}


def test_set_operators_on_odd_rows(spark, odd):  # noqa: F811
    assert exact_dedup.find_copies(odd).count() == len(ODD)
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns and kept.count() == 8
    assert near_dedup.find_near(odd).count() == len(ODD)
    assert near_dedup.drop_near(odd).columns == odd.columns
    mixed = mixing.mix(odd)
    assert mixed.count() == len(ODD) and mixing.mixed(odd).columns == odd.columns
    placed = sharding.assign_shards(odd)
    assert placed.count() == len(ODD) and placed.select("shard").distinct().count() > 1


def test_set_operators_on_empty_tables(spark, odd):  # noqa: F811
    none = odd.limit(0)
    for f in (exact_dedup.find_copies, exact_dedup.drop_copies, near_dedup.find_near, near_dedup.drop_near, mixing.mix, mixing.mixed, sharding.assign_shards):
        assert f(none).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.search(vectors, F.lit(True)).count() == 0


def brute_components(rows, k, percent=80):
    sets = {}
    for d, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        w = min(k, len(words))
        sets[d] = {tuple(words[i : i + w]) for i in range(len(words) - w + 1)} if w else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_near_copies(spark, k):
    rng = random.Random(k)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(3))
    rows, at = [(0, None), (1, ""), (2, " \t"), (3, "one"), (4, "ONE"), (5, "one two")], 10
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 8, 60, 300]))]
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 3])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((at, " ".join(copy)))
            at += rng.randrange(1, 4)
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.find_near(spark.createDataFrame(rows, "doc_id long, text string"), words=k).collect()}
    assert got == brute_components(rows, k)


def test_large_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    rows = [(k, " ".join([*base[:199], f"x{k}"])) for k in range(600)]
    got = near_dedup.find_near(spark.createDataFrame(rows, "doc_id long, text string"), words=2).select("component_id").distinct().collect()
    assert [r.component_id for r in got] == [0]


@pytest.mark.parametrize("at_once", [20_000, 4_000])
def test_variants_of_one_template(spark, monkeypatch, at_once):
    monkeypatch.setattr(near_dedup, "LEAST", at_once)
    monkeypatch.setattr(near_dedup, "SLICE", 0)
    monkeypatch.setattr(near_dedup, "TILE", 16)
    rng = random.Random(11)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(300):
        text = list(base)
        for place in rng.sample(range(200), rng.randrange(6, 11)):
            text[place] = f"x{rng.randrange(3)}"
        rows.append((k, " ".join(text)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.find_near(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()}
    assert got == brute_components(rows, 2)


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[k], order[k + 1]) for k in range(199)] + [(500, 501), (502, 502)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert {got[k] for k in range(200)} == {0} and got[501] == got[500] == 500 and 502 not in got


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.8):
        agree = []
        for n in (5, 40, 2000):
            for _ in range(60):
                pool = rng.integers(1, 1 << 63, 2 * n, dtype=np.uint64)
                both = int(round(2 * n * share / (1 + share)))
                a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:both], pool[n : 2 * n - both]]))
                true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
                agree.append((near_dedup.signature(a) == near_dedup.signature(b)).mean() - true)
        assert abs(np.mean(agree)) < 0.03


def test_hashing_does_not_depend_on_blocks(monkeypatch):
    texts = ["a b c " * 200, None, "x", "d e  f\tg " * 50, ""]
    whole = [s.tolist() for s in near_dedup._sets(texts, 3)]
    monkeypatch.setattr(near_dedup, "BLOCK", 64)
    assert [s.tolist() for s in near_dedup._sets(texts, 3)] == whole


def test_neighbours_are_exact_on_small_tables(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 8)).round(2)
    x[50:120] = x[50]
    rows = [(k, [float(v) for v in x[k]]) for k in range(400)] + [(400, None), (500, [0.0] * 8), (600, [float("nan")] + [1.0] * 7), (700, [None] + [1.0] * 7), (800, [1.0, 2.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 400, 10))
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [k for k in np.lexsort((np.arange(400), d)) if k != q][:10]
        assert [v for v, _ in found] == order and [s for _, s in found] == [d[k] for k in order]


def test_neighbours_recall(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 300)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 16)) + 3 * rng.normal(size=(12, 16))[rng.integers(0, 12, 3000)]
    df = spark.createDataFrame([(k, [float(v) for v in x[k]]) for k in range(3000)], "vec_id long, embedding array<double>")
    hits = total = 0
    index = neighbours.fit_index(x, 3000, 300)
    assert index.parts > 1 and np.bincount(index.own(x), minlength=index.parts).max() < 3000
    for r in neighbours.search(df, F.col("vec_id") % 50 == 0).groupBy("query_id").agg(F.collect_list("vec_id").alias("v")).collect():
        d = ((x - x[r.query_id]) ** 2).sum(1)
        d[r.query_id] = np.inf
        hits += len(set(r.v) & set(np.argsort(d)[:10].tolist()))
        total += 10
    assert total == 600 and hits / total >= 0.9


def test_balanced_parts():
    x = np.random.default_rng(1).normal(size=(1000, 6))
    part = neighbours.balanced_parts(x, neighbours.neighbour_graph(x), 8)
    assert np.bincount(part, minlength=8).min() >= 1000 / 8 / 1.1 - 2 and np.bincount(part).max() <= 1.1 * 1000 / 8 + 2


def test_targets():
    assert mixing.fill_targets([10, 1000, 1000]) == [20.0, 1996.6666666666667, 998.3333333333334]
    for sizes in ([1], [0, 5], [3, 3, 3, 3, 3], [0]):
        t = mixing.fill_targets(sizes)
        assert abs(sum(t) - 1.5 * sum(sizes)) < 1e-9 and all(x <= 2 * s for x, s in zip(t, sizes))


def test_budgets_are_met_as_well_as_can_be():
    rng = np.random.default_rng(5)
    for _ in range(200):
        sizes = np.sort(rng.choice(np.arange(1, 60), rng.integers(1, 6), replace=False))
        counts = rng.integers(1, 4, len(sizes))
        sums = {0}
        for s, n in zip(sizes, counts):
            sums = {a + int(s) * k for a in sums for k in range(n + 1)}
        budget = int(rng.integers(0, (sizes * counts).sum() + 1))
        take = mixing.fit_budget(sizes, counts, budget)
        assert ((take >= 0) & (take <= counts)).all()
        got = abs(int((take * sizes).sum()) - budget)
        assert got <= max(min(abs(s - budget) for s in sums), int(sizes.max()) // 2)


def test_mix_counts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE", 20)
    rng = random.Random(2)
    rows = [(k, " ".join(["w"] * (7 if k % 3 else rng.randrange(0, 40))), f"s{k % 4}" if k % 11 else None) for k in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    by = {}
    for r in got:
        s = by.setdefault(r.source, [0, r.source_size, r.target, 0])
        s[0] += r.size
        s[3] += r.size * r.copies
        assert 0 <= r.copies <= 2
    assert all(s[0] == s[1] and abs(s[2] - s[3]) <= 1 for s in by.values())
    again = {r.doc_id: r.copies for r in mixing.mix(df.repartition(7)).collect()}
    assert again == {r.doc_id: r.copies for r in got}
    assert mixing.mixed(df).count() == sum(r.copies for r in got)


def test_table_is_fair_and_moves_few():
    names = sharding.shard_names(20)
    table = sharding.fill_table(names, 1009)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1 and len(table) == 1009
    less = sharding.fill_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, less) if a != 19)
    assert moved < 0.25 * 1009
    for bad in ((names, 1000), ([], 1009), (["a", "a"], 1009)):
        with pytest.raises(ValueError):
            sharding.fill_table(*bad)


def test_written_shards(spark, tmp_path):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    sharding.write_shards(df, str(tmp_path / "out"), shards=["a", "b", "c"], slots=101)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500 and back.select("shard").distinct().count() == 3


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, sf)
    assert clean.columns == docs.columns and 0 < clean.count() <= docs.count()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    last = {}
    for d, t in rows:
        key = (t or "").translate(LOWER)
        last[key] = max(d, last.get(key, d))
    assert sorted(r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, sf).collect()) == sorted(last.values())
    near = brute_components([(d, t) for d, t in rows], 5)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near(spark, docs, sf).collect()) == sorted(d for d, (_, c) in near.items() if c == d)
    mixed = corpus_pipeline.mix(spark, docs, sf)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert corpus_pipeline.encode(spark, docs, sf).count() == docs.count()


def test_pipeline_on_odd_and_empty_tables(spark, sf):
    df = spark.createDataFrame(ODD, SCHEMA)
    for rows in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, sf)
        assert rows.count() >= 0


def test_neighbours_of_repeated_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 4)).astype(np.float32)
    x[20:40] = x[0]
    rows = [(k, v.tolist()) for k, v in enumerate(x) for _ in range({0: 11, 1: 2, 2: 30}.get(k, 1))]
    got = {}
    for r in neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") < 3).collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    for q in range(3):
        d = sorted((float(np.linalg.norm(x[q].astype(float) - np.array(v))), i) for i, v in rows if i != q)
        assert [i for _, i in sorted(got[q])] == [i for _, i in d[:10]]


def matrix_components(rows, k, percent=80):
    """The same as brute_components, with all pairs' intersections as one product of matrices."""
    sets = [{tuple(t.split()[i : i + k]) for i in range(len(t.split()) - k + 1)} for _, t in rows]
    number = {}
    x = np.zeros((len(rows), len({s for own in sets for s in own})), np.float32)
    for r, own in enumerate(sets):
        x[r, [number.setdefault(s, len(number)) for s in own]] = 1
    both, n = x @ x.T, x.sum(1)
    link = 100 * both >= percent * (n[:, None] + n[None] - both)
    label = np.arange(len(rows))
    while True:
        less = np.where(link, label[None], len(rows)).min(1)
        if (less == label).all():
            return {rows[r][0]: (len(sets[r]), rows[label[r]][0]) for r in range(len(rows))}
        label = less


def test_templates_with_edited_twins(spark):
    rng = random.Random(29)
    base = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(700):
        text = list(base)
        for place in rng.sample(range(400), 29):
            text[place] = f"x{k}.{place}"
        twin = list(text)
        for place in rng.sample(range(400), 20):
            twin[place] = f"y{k}.{place}"
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(twin))]
    expected = matrix_components(rows, 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.find_near(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()}
    assert got == expected and 700 <= len({c for _, c in got.values()}) < 1400


def test_bit_maps_never_hide_a_link():
    rng = np.random.default_rng(8)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(1, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(0.7, 1)], rng.integers(1, 1 << 63, int(rng.integers(0, n // 4 + 2)), dtype=np.uint64)]))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        link = 100 * both >= 80 * (len(a) + len(b) - both)
        may = near_dedup.may_link([near_dedup.bit_map(a)], [near_dedup.bit_map(b)], np.array([0]), np.array([0]), np.array([len(a)]), np.array([len(b)]), 80)
        assert may[0] or not link


def test_repeated_ids_with_different_texts(spark):
    texts = [" ".join(f"w{j}" for j in range(at, at + 60)) for at in (0, 1, 500, 501, 900)]
    rows = [(1, texts[0]), (2, texts[1]), (1, texts[2]), (3, texts[3]), (4, texts[4]), (4, texts[4]), (None, texts[4])]
    got = sorted((r.doc_id, r.component_id) for r in near_dedup.find_near(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect() if r.doc_id)
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4)]


def test_salted_join(spark):
    from quarry.llm.shared import salted_join

    rows = spark.range(5000).selectExpr("if(id % 3 = 0, 0, id % 50) as k", "id as v")
    table = spark.range(60).selectExpr("id as k", "id * 10 as w")
    got = salted_join(rows, "k", table, 300)
    assert got.count() == 5000 and got.where("w <> k * 10").count() == 0 and set(got.columns) == {"k", "v", "w"}


@pytest.mark.parametrize("rows", [[(5, "w w w w w", "a")] * 1000 + [(k, "v " * (k % 7), "b") for k in range(400)], [(k % 3, "w " * (1 + k % 2), "a" if k % 5 else None) for k in range(900)]])
def test_mix_of_repeated_ids(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    for found in (mixing.mix(df), mixing.mix(df, keep=["doc_id"]), mixing.mix(df.withColumn("m", F.create_map(F.lit("a"), F.lit(1))))):
        got = found.collect()
        assert len(got) == len(rows) and all(0 <= r.copies <= 2 for r in got)
        taken = {}
        for r in got:
            own = taken.setdefault((r.source_size, r.target), [0])
            own[0] += r.size * r.copies
        assert all(abs(target - own[0]) <= 6 for (_, target), own in taken.items())


def test_exact_copies_with_columns_without_order(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "A", 4), (2, "a", 6), (3, "b", 1)], "doc_id long, text string, z int").withColumn("m", F.create_map(F.lit("k"), F.col("z")))
    got = sorted((r.doc_id, r.text, r.z, r.m["k"]) for r in exact_dedup.drop_copies(df).collect())
    assert got == [(2, "a", 6, 6), (3, "b", 1, 1)]


def test_tables_in_slices_let_single_rows_pass(spark):
    from quarry.llm.shared import stored

    keys = stored(spark.range(4000).selectExpr("sha2(cast(if(id < 3800, id, id - 3800) as string), 256) as sha"), "test-keys")
    marked = exact_dedup.flagged_keys(keys, "sha", 4000, 1 << 14)
    assert marked.count() == 4000 and 400 <= marked.where("__maybe").count() < 650
    assert marked.where("__maybe").groupBy("sha").count().where("count > 1").count() == 200


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_neighbours_of_the_tables(spark, scale):
    df = spark.read.parquet(f"/root/testdata/{scale}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    index = neighbours.fit_index(x, len(x))
    visits = np.mean([len(v) for v in index.visits(x[ids % 100 == 0])]) / index.parts
    assert index.parts == len(x) // neighbours.PART_ROWS > 1 and 0 < visits <= 1
    found = {}
    for r in neighbours.search(df, F.col("vec_id") % 100 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in ids[ids % 100 == 0]:
        d = ((x - x[ids == q]) ** 2).sum(1)
        d[ids == q] = np.inf
        hits += len(found[q] & set(ids[np.argsort(d, kind="stable")[:10]].tolist()))
    print(scale, index.parts, visits, hits / (10 * len(found)))
    assert hits / (10 * len(found)) >= 0.9


def test_visits_are_few_where_vectors_have_structure():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(8000, 16)) * 0.3 + 3 * rng.normal(size=(60, 16))[rng.integers(0, 60, 8000)]
    index = neighbours.fit_index(x, 8000)
    visits = np.mean([len(v) for v in index.visits(x)]) / index.parts
    assert index.parts == 32 and visits < 0.25
