"""Graph building, reconciliation and traversal. Orders stand for services, parts for materials, suppliers for legal bases, customers and nations for departments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as tx
from ..operators import dedup, graph, traverse, validate
from ..plans.retrieval import LIMITS
from .base import register, table

QUERIES: dict = {}
SQL: dict[str, str] = {}
query = register(QUERIES, SQL)

LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate"
_LINE = LINE.split(", ")


def _materials(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.concat(F.lit("o"), "l_orderkey").alias("src"), F.lit("requires").alias("rel"), F.concat(F.lit("p"), "l_partkey").alias("dst"))


def _departments(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("src"), F.lit("handledBy").alias("rel"), F.concat(F.lit("c"), "o_custkey").alias("dst"))


@query("""with c as (select distinct r_name || '-' || n_name || '-' || c_mktsegment as id from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
p as (select string_split(id, '-') as p from c), e as (select p, unnest(range(1, len(p) + 1)) as n from p)
select distinct array_to_string(p[1:n], '-') as id, case when n > 1 then array_to_string(p[1:n - 1], '-') end as parent from e""")
def concept_ancestors(spark, sf):
    customers = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return graph.with_ancestors(customers.select(F.concat_ws("-", "r_name", "n_name", "c_mktsegment").alias("id")).distinct(), "id")


_TREE = """with recursive edges as (select 'n' || n_nationkey as child, 'r' || n_regionkey as parent from nation union all select 'r' || r_regionkey, 'world' from region),
tree as (select 'world' as id, 0 as depth, 'world' as path union all select e.child, t.depth + 1, t.path || '/' || e.child from edges e join tree t on e.parent = t.id)
select id, depth, path from tree"""


@query(_TREE)
def category_tree_recursive(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    text = _TREE.replace("from nation", "from {nation}").replace("from region", "from {region}")
    return spark.sql(text, nation=nation, region=region)


_SAFE = "regexp_replace(regexp_replace(regexp_replace({}, '\\s+', '_', 'g'), '[^\\p{{L}}\\p{{N}}_.-]+', '_', 'g'), '^_+|_+$', '', 'g')"


@query(f"""with s as (select distinct p_brand as l1, p_type as l2 from part),
n as (select 'Domain' as type, 'domain:part' as id, 'part' as name from s union all select 'Category', 'category:part:' || {_SAFE.format('l1')}, l1 from s
 union all select 'Category', 'category:part:' || {_SAFE.format("(l1 || '/' || l2)")}, l2 from s union all select 'Model', 'model:part:' || {_SAFE.format('l1')}, l1 from s)
select distinct type, id, name from n""")
def routing_nodes(spark, sf):
    return graph.routing(table(spark, sf, "part").select(F.col("p_brand").alias("category_l1"), F.col("p_type").alias("category_l2")), "part")[0]


@query(f"""with s as (select distinct p_brand as l1, p_type as l2 from part)
select distinct 'category:part:' || {_SAFE.format('l1')} as src, 'belongsToDomain' as rel, 'domain:part' as dst from s
union select 'category:part:' || {_SAFE.format("(l1 || '/' || l2)")}, 'childOf', 'category:part:' || {_SAFE.format('l1')} from s
union select 'model:part:' || {_SAFE.format('l1')}, 'modelOf', 'category:part:' || {_SAFE.format('l1')} from s""")
def routing_edges(spark, sf):
    return graph.routing(table(spark, sf, "part").select(F.col("p_brand").alias("category_l1"), F.col("p_type").alias("category_l2")), "part")[1]


_SHARED = "'M-' || substr(md5(lower(replace(p_name, ' ', ''))), 1, 16)"


@query(f"select {_SHARED} as id, min_by(p_name, p_partkey) as name, count(distinct p_partkey) as merged from part group by 1")
def shared_node_merge(spark, sf):
    canonical = F.lower(F.replace("p_name", F.lit(" "), F.lit("")))
    return graph.share_nodes(table(spark, sf, "part"), F.col("p_name"), canonical, "M", "p_partkey", "p_partkey")[0]


@query(f"""with m as (select p_partkey as old_id, {_SHARED} as new_id from part where p_partkey % 7 <> 0)
select l_orderkey, l_linenumber, l_quantity, coalesce(new_id, l_partkey::varchar) as material, l_partkey::varchar as source_material, new_id is not null as mapped from lineitem left join m on l_partkey = old_id""")
def edge_id_rewrite(spark, sf):
    canonical = F.lower(F.replace("p_name", F.lit(" "), F.lit("")))
    mapping = graph.share_nodes(table(spark, sf, "part").where("p_partkey % 7 <> 0").withColumn("id", F.col("p_partkey").cast("string")), F.col("p_name"), canonical, "M", "id", "p_partkey")[1]
    edges = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_partkey").cast("string").alias("material"))
    return graph.rewrite_edges(edges, "material", mapping, keep="source_material")


_CITED = f"""with k as (select row_number() over (order by {LINE}, l_returnflag, l_linestatus) as seq, 'law ' || l_suppkey as law, case when l_partkey % 5 = 0 then '' else 'no ' || (l_partkey % 40) end as doc,
  'art ' || (l_partkey % 3) as article, l_returnflag as content from lineitem),
j as (select *, case when doc = '' then law else doc end as doc_key, md5(content) as digest from k),
i as (select *, 'LB-' || substr(md5(law || '|' || doc_key), 1, 16) as basis_id, 'LC-' || substr(md5(law || '|' || doc_key || '|' || article), 1, 16) as citation_id from j),
f as (select citation_id, min_by(digest, seq) as first_digest from i group by 1)"""


def _law_rows(spark, sf) -> DataFrame:
    # The line's own columns are its order: a number is only needed to choose the first, so the columns themselves serve as seq.
    seq = F.struct(*_LINE, "l_returnflag", "l_linestatus")
    doc = F.when(F.col("l_partkey") % 5 == 0, "").otherwise(F.concat(F.lit("no "), F.col("l_partkey") % 40))
    return table(spark, sf, "lineitem").select(seq.alias("seq"), F.concat(F.lit("law "), "l_suppkey").alias("law"), doc.alias("doc"), F.concat(F.lit("art "), F.col("l_partkey") % 3).alias("article"), F.col("l_returnflag").alias("content"))


@query(_CITED + " select i.citation_id, min(basis_id) as basis_id, min(law || ' ' || article) as name, count(*) as sources, count(*) filter (digest <> first_digest) as conflicts from i join f on i.citation_id = f.citation_id group by 1")
def citation_split(spark, sf):
    return graph.citations(_law_rows(spark, sf))[0]


@query(_CITED + " select basis_id, min(law) as law, min(doc_key) as doc_no, count(*) as sources, count(*) filter (doc = '') as fallbacks from i group by 1")
def basis_rollup(spark, sf):
    return graph.citations(_law_rows(spark, sf))[1]


@query(f"select l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice from (select *, row_number() over (partition by l_orderkey, l_partkey order by {', '.join(c + ' desc' for c in _LINE)}, l_returnflag desc, l_linestatus desc) as r from lineitem) where r = 1")
def edge_upsert_last(spark, sf):
    lines = table(spark, sf, "lineitem")
    return dedup.last_wins(lines, ["l_orderkey", "l_partkey"], [*_LINE, "l_returnflag", "l_linestatus"]).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query(f"select l_orderkey as src, l_partkey as dst, l_linenumber, l_quantity, l_extendedprice from (select *, row_number() over (partition by l_orderkey, l_partkey order by {LINE}, l_returnflag, l_linestatus) as r from lineitem) where r = 1")
def edge_dedup_first(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnsRenamed({"l_orderkey": "src", "l_partkey": "dst"})
    order = ["src" if c == "l_orderkey" else "dst" if c == "l_partkey" else c for c in [*_LINE, "l_returnflag", "l_linestatus"]]
    return graph.dedup_edges(lines, order).select("src", "dst", "l_linenumber", "l_quantity", "l_extendedprice")


@query("""select 'conv' || conv_id || '#P' || lpad(turn::varchar, greatest(2, length(turn::varchar))::int, '0') as id, 'conv' || conv_id as parent, role, length(text)::int as n from conversations""")
def node_edge_explode(spark, sf):
    turns = table(spark, sf, "conversations").withColumn("parent", F.concat(F.lit("conv"), "conv_id"))
    return turns.select(ids.ordinal_id("parent", "P", F.col("turn")).alias("id"), "parent", "role", F.length("text").alias("n"))


@query("select event_id as src, nxt as dst from (select event_id, lead(event_id) over (partition by user_id order by ts, event_id) as nxt from events) where nxt is not null")
def next_step_edges(spark, sf):
    return graph.next_edges(table(spark, sf, "events"), "user_id", ["ts", "event_id"], "event_id")


@query("""with c as (select o_orderkey, o_orderpriority || ',' || o_orderstatus || '; ' || o_orderstatus || ' ,,' || coalesce((o_custkey % 3)::varchar, '') as cell from orders),
s as (select o_orderkey, unnest(list_distinct(list_filter(list_transform(regexp_split_to_array(cell, '[,，、;；]+'), lambda x: trim(x)), lambda x: x <> ''))) as dst from c)
select 'o' || o_orderkey as src, 'tagged' as rel, dst from s""")
def multi_value_explode(spark, sf):
    cell = F.concat("o_orderpriority", F.lit(","), "o_orderstatus", F.lit("; "), "o_orderstatus", F.lit(" ,,"), F.coalesce((F.col("o_custkey") % 3).cast("string"), F.lit("")))
    return graph.edges_of_cell(table(spark, sf, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("o"), cell.alias("cell")), "o", "cell", "tagged")


@query("""with e as (select case when l_linenumber = 1 and l_quantity > 49 then '' else l_orderkey::varchar end as ref from lineitem), n as (select o_orderkey::varchar as k from orders where o_orderkey % 7 <> 0)
select count(*) filter (trim(ref) = '') as empty, count(*) filter (trim(ref) <> '' and k is null) as missing, count(distinct case when trim(ref) <> '' and k is null then ref end) as missing_distinct from e left join n on ref = k""")
def referential_integrity(spark, sf):
    edges = table(spark, sf, "lineitem").select(F.when((F.col("l_linenumber") == 1) & (F.col("l_quantity") > 49), "").otherwise(F.col("l_orderkey").cast("string")).alias("ref"))
    return validate.missing_references(edges, "ref", table(spark, sf, "orders").where("o_orderkey % 7 <> 0"), "o_orderkey")


@query("""with e as (select 'requires' as rel, count(*) as n from (select distinct l_orderkey, l_partkey from lineitem) union all select 'node:part', count(*) from part union all select 'handledBy', count(*) from orders),
a as (select 'requires' as rel, count(*) as n from lineitem union all select 'node:part', count(distinct p_partkey) from part union all select 'extra', count(*) from supplier)
select coalesce(e.rel, a.rel) as rel, coalesce(e.n, 0) as expected, coalesce(a.n, 0) as actual, coalesce(a.n, 0) - coalesce(e.n, 0) as diff, coalesce(a.n, 0) = coalesce(e.n, 0) as ok from e full outer join a on e.rel = a.rel""")
def reconcile_counts(spark, sf):
    lines, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    count = lambda df, rel: df.agg(F.count("*").alias("n")).select(F.lit(rel).alias("rel"), "n")
    expected = count(lines.select("l_orderkey", "l_partkey").distinct(), "requires").unionByName(count(parts, "node:part")).unionByName(count(table(spark, sf, "orders"), "handledBy"))
    actual = count(lines, "requires").unionByName(count(parts.select("p_partkey").distinct(), "node:part")).unionByName(count(table(spark, sf, "supplier"), "extra"))
    return graph.reconcile(expected, actual, ["rel"])


@query("""with h as (select distinct 'o' || l_orderkey as src, 'p' || l_partkey as dst from lineitem join orders on l_orderkey = o_orderkey where o_orderpriority like '1%')
select src, dst from (select *, row_number() over (partition by src order by dst) as r from h) where r <= 30""")
def traverse_out(spark, sf):
    urgent = table(spark, sf, "orders").where("o_orderpriority like '1%'").select(F.concat(F.lit("o"), "o_orderkey").alias("id"))
    return traverse.first_hops(traverse.hop(urgent, _materials(spark, sf), "requires"))


@query("select distinct 'p' || p_partkey as src, 'o' || l_orderkey as dst from part join lineitem on p_partkey = l_partkey where p_size = 1")
def traverse_in(spark, sf):
    small = table(spark, sf, "part").where("p_size = 1").select(F.concat(F.lit("p"), "p_partkey").alias("id"))
    return traverse.hop(small, _materials(spark, sf), "requires", out=False)


@query("select distinct 'o' || o_orderkey as src, 'c' || o_custkey as mid, 'n' || c_nationkey as dst from orders join customer on o_custkey = c_custkey where o_totalprice > 200000")
def two_hop_chain(spark, sf):
    large = table(spark, sf, "orders").where("o_totalprice > 200000").select(F.concat(F.lit("o"), "o_orderkey").alias("id"))
    second = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("src"), F.concat(F.lit("n"), "c_nationkey").alias("dst"))
    return traverse.chain(large, _departments(spark, sf), second)


@query("select distinct 'c' || c_custkey as id, 'o' || o.o_orderkey as order_key from customer left join (select * from orders where o_orderstatus = 'P') o on c_custkey = o_custkey where c_acctbal > 5000")
def optional_match(spark, sf):
    rich = table(spark, sf, "customer").where("c_acctbal > 5000").select(F.concat(F.lit("c"), "c_custkey").alias("id"))
    edges = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.concat(F.lit("c"), "o_custkey").alias("src"), F.concat(F.lit("o"), "o_orderkey").alias("dst"))
    return traverse.optional(rich, edges, "id", "order_key")


@query("""select r_name, n_name, count(*) as lines, count(distinct l_partkey) as parts, round(sum(l_extendedprice), 2) as price from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey join supplier on l_suppkey = s_suppkey where s_acctbal > 0 group by all""")
def star_join(spark, sf):
    t = lambda name: table(spark, sf, name)
    joined = t("lineitem").join(t("supplier").where("s_acctbal > 0"), F.col("l_suppkey") == F.col("s_suppkey")).join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name", "n_name").agg(F.count("*").alias("lines"), F.count_distinct("l_partkey").alias("parts"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("""with e as (select distinct 'o' || l_orderkey as src, 'p' || l_partkey as dst from lineitem), d as (select dst as anchor, count(*) as degree from e group by 1)
select a.src, a.dst as anchor, b.src as other from e a join d on a.dst = d.anchor and degree between 2 and 20 join e b on a.dst = b.dst and a.src <> b.src""")
def shared_anchor_reverse(spark, sf):
    return traverse.shared_anchor(_materials(spark, sf), 20)


@query("""with e as (select distinct 's' || l_suppkey as src, 'p' || l_partkey as dst from lineitem), b as (select src, dst from e union select dst, src from e), s as (select 's' || s_suppkey as id from supplier where s_acctbal > 9000),
h1 as (select distinct b.dst as id from b join s on b.src = s.id where b.dst not in (select id from s)), h2 as (select distinct b.dst as id from b join h1 on b.src = h1.id where b.dst not in (select id from s) and b.dst not in (select id from h1))
select id, 0 as distance from s union all select id, 1 from h1 union all select id, 2 from h2""")
def neighborhood_expand(spark, sf):
    edges = table(spark, sf, "lineitem").select(F.concat(F.lit("s"), "l_suppkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst"))
    start = table(spark, sf, "supplier").where("s_acctbal > 9000").select(F.concat(F.lit("s"), "s_suppkey").alias("id"))
    return traverse.neighbourhood(start, edges, 2)


@query("""with u as (select distinct o_orderkey, p_name from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey),
r as (select *, row_number() over (partition by o_orderkey order by p_name) as r from u), l as (select o_orderkey, string_agg(p_name, '、' order by p_name) as names from r where r <= 20 group by 1)
select o.o_orderkey, 'Order ' || o.o_orderkey || chr(10) || 'Customer: ' || c_name || chr(10) || 'Materials: ' || coalesce(names, '') as context from orders o join customer on o_custkey = c_custkey left join l on o.o_orderkey = l.o_orderkey""")
def context_render(spark, sf):
    t = lambda name: table(spark, sf, name)
    named = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("o_orderkey"), "p_name")
    names = traverse.collected(named, "o_orderkey", F.col("p_name"), F.col("p_name"), LIMITS["material"], "names")
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(names, "o_orderkey", "left")
    text = F.concat_ws("\n", F.concat(F.lit("Order "), "o_orderkey"), F.concat(F.lit("Customer: "), "c_name"), F.concat(F.lit("Materials: "), F.coalesce("names", F.lit(""))))
    return rows.select("o_orderkey", text.alias("context"))


@query("""with n as (select o_orderkey, o_custkey from orders where o_totalprice > 150000), o as (select distinct o_custkey as id from n)
select 'other orders of customer ' || c_name || '?' as question, array_to_string(list_transform(list_sort(list(o_orderkey))[1:8], lambda x, i: i || '. ' || x), chr(10)) as expected_answer
from orders join customer on o_custkey = c_custkey where o_custkey in (select id from o) group by c_custkey, c_name having count(*) between 3 and 8""")
def testset_render(spark, sf):
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    chosen = orders.where("o_totalprice > 150000").select("o_custkey").distinct()
    rows = orders.join(chosen, "o_custkey", "left_semi").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    counts = rows.groupBy("c_custkey", "c_name").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("o_orderkey")).alias("keys")).where("n between 3 and 8")
    answer = tx.numbered(F.transform(F.slice("keys", 1, 8), lambda x: x.cast("string")))
    return counts.select(F.concat(F.lit("other orders of customer "), "c_name", F.lit("?")).alias("question"), answer.alias("expected_answer"))
