"""Queries over whole texts and tables, on small tables of their own."""

from quarry.queries import graph, search


def _conversations(spark, path, turns):
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return str(path)


def test_scores_of_whole_texts(spark, tmp_path):
    sf = _conversations(spark, tmp_path, [(1, 0, "user", "a " * 150 + "b"), (1, 1, "assistant", "a " * 150 + "c"), (2, 0, "user", "a " * 150 + "b"), (2, 1, "assistant", "A " * 150 + "B")])
    assert {r.test_id: (r.em, r.f1) for r in search.em_f1_score(spark, sf).collect()} == {"1-0": (0, round(300 / 302, 6)), "2-0": (1, 1.0)}
    assert {r.level: r.em for r in search.score_grouping_sets(spark, sf).collect()}["all"] == 0.5


def test_bags_of_whole_texts(spark, tmp_path):
    sf = _conversations(spark, tmp_path, [(3, 0, "user", "same start, one end"), (3, 5, "assistant", "same start, other end"), (4, 0, "user", "same start, third end")])
    assert [tuple(r) for r in search.bag_match_ab(spark, sf).collect()] == [(0, 1, 1, 1)]


def test_bounds_of_the_reference(spark, tmp_path):
    spark.range(7).selectExpr("1L as l_orderkey", "id as l_partkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(7).selectExpr("id as p_partkey", "concat('n', id) as p_name").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(1).selectExpr("1L as o_orderkey", "5L as o_custkey", "'1-URGENT' as o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1).selectExpr("5L as c_custkey", "'c' as c_name").write.parquet(f"{tmp_path}/customer.parquet")
    assert graph.traverse_out(spark, str(tmp_path)).count() == 7
    assert graph.context_render(spark, str(tmp_path)).first().context.endswith("n0、n1、n2、n3、n4、n5、n6")


def test_every_label_is_searched(spark, sf):
    found = {r.label for r in search.multi_index_topk(spark, sf).collect()}
    labels = {f"label{r.label}" for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("label").distinct().collect()}
    assert labels - {"label0"} <= found and len(labels) > 3
