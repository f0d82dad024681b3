"""Vector search, plans, chunks, samples, scoring, propositions, state and streams."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import chunk, dedup, propositions, sample, score, state, vector
from ..plans import hops, retrieval
from ..plans.variants import LAYERED
from ..sources import sinks
from ..streaming import streams
from .base import register, spread, table

QUERIES: dict = {}
SQL: dict[str, str] = {}
query = register(QUERIES, SQL)


def _first_vector(spark, sf) -> list[float]:
    return list(table(spark, sf, "embeddings").orderBy("vec_id").first().embedding)


_COSINE = "round(list_cosine_similarity(e.embedding::double[], q.v::double[]), 6)"


@query(f"with q as (select embedding as v from embeddings order by vec_id limit 1) select vec_id, {_COSINE} as score from embeddings e, q where {_COSINE} >= -1 order by score desc, vec_id limit 20")
def vector_topk(spark, sf):
    return vector.top_k(table(spark, sf, "embeddings"), _first_vector(spark, sf), 20, "vec_id", "embedding").select("vec_id", "score")


@query(f"""with q as (select embedding as v from embeddings order by vec_id limit 1), s as (select label, vec_id, {_COSINE} as score from embeddings e, q where label is not null),
r as (select *, row_number() over (partition by label order by score desc, vec_id) as r from s where score >= case label when 0 then 0.05 else -1 end)
select 'label' || label as label, vec_id::varchar as id, vec_id::varchar as name, score from r where r <= 5""")
def multi_index_topk(spark, sf):
    """An index for each label of the table, five rows of each."""
    rows = table(spark, sf, "embeddings")
    labels = sorted(r.label for r in rows.select("label").where("label is not null").distinct().collect())
    indexes = [(f"label{k}", rows.where(F.col("label") == k), "vec_id", "embedding", "vec_id", 5, 0.05 if k == 0 else -1.0) for k in labels]
    return vector.search_all(indexes, _first_vector(spark, sf))


@query("""with r as (select vec_id, label, case when vec_id % 5 = 0 then list_transform(embedding, lambda x: 0.0::float) when vec_id % 7 = 0 then null else embedding end as v, case when vec_id % 11 = 0 then '' else 'text ' || vec_id end as text from embeddings)
select vec_id, case when trim(text) = '' then 'skipped_empty' when vec_id % 13 = 0 or not (v is null or len(list_filter(v, lambda x: x <> 0)) = 0) then 'skipped_done' else 'todo' end as state from r""")
def zero_vector_worklist(spark, sf):
    v = F.when(F.col("vec_id") % 5 == 0, F.transform("embedding", lambda x: F.lit(0.0).cast("float"))).when(F.col("vec_id") % 7 == 0, F.lit(None)).otherwise(F.col("embedding"))
    rows = table(spark, sf, "embeddings").withColumn("v", v).withColumn("text", F.when(F.col("vec_id") % 11 == 0, "").otherwise(F.concat(F.lit("text "), "vec_id")))
    done = table(spark, sf, "embeddings").where("vec_id % 13 = 0").select("vec_id")
    return vector.worklist(rows, "text", "v", "vec_id", done).select("vec_id", "state")


def _graph(spark, sf) -> hops.Graph:
    """Orders as services, parts as materials, customers as departments. Vectors are those of the embeddings with the same number."""
    t = lambda name: table(spark, sf, name)
    node = lambda df, mark, key, name: df.select(F.concat(F.lit(mark), key).alias("id"), F.col(name).cast("string").alias("name"))
    empty = spark.createDataFrame([], "id string, name string")
    nodes = {k: empty for k in LAYERED.types} | {"service": node(t("orders"), "o", "o_orderkey", "o_orderkey"), "material": node(t("part"), "p", "p_partkey", "p_name"), "department": node(t("customer"), "c", "c_custkey", "c_name")}
    v = t("embeddings").select("vec_id", F.col("embedding").alias("vector"))
    vectors = {"service": v.select(F.concat(F.lit("o"), F.col("vec_id") + 1).alias("id"), (F.col("vec_id") + 1).cast("string").alias("name"), "vector"), "material": v.select(F.concat(F.lit("p"), F.col("vec_id") + 1).alias("id"), F.concat(F.lit("part "), F.col("vec_id") + 1).alias("name"), "vector")}
    edges = t("lineitem").select(F.concat(F.lit("o"), "l_orderkey").alias("src"), F.lit("requiresMaterial").alias("rel"), F.concat(F.lit("p"), "l_partkey").alias("dst"))
    edges = edges.unionByName(t("orders").select(F.concat(F.lit("o"), "o_orderkey").alias("src"), F.lit("handledBy").alias("rel"), F.concat(F.lit("c"), "o_custkey").alias("dst")))
    return hops.Graph(LAYERED, nodes, vectors, edges)


PLAN = '```json\n{"hops": [{"action": "locate", "type": "事项", "query": "first", "bind": "a1"}, {"action": "traverse", "from": "a1", "relation": "所需材料", "bind": "m1"}, {"action": "traverse", "from": "m1", "relation": "requiresMaterial", "direction": "in", "bind": "a2"}]}\n```'


@query("""with e as (select distinct l_orderkey as o, l_partkey as p from lineitem), q as (select vec_id + 1 as o from embeddings order by vec_id limit 1),
m as (select distinct p from e where o in (select o from q)), m30 as (select p from m order by 'p' || p limit 30), a as (select distinct 'o' || o as id, o::varchar as name from e join m30 on e.p = m30.p)
select id, name from a join orders on 'o' || o_orderkey = id order by id limit 30""")
def multihop_plan(spark, sf):
    first = _first_vector(spark, sf)
    run = hops.run_plan(_graph(spark, sf), PLAN, "which orders share parts with the first?", lambda text: first)
    return run.bound["a2"][1]


@query(f"""with q as (select embedding as v from embeddings order by vec_id limit 1), s as (select 'o' || (vec_id + 1) as id, (vec_id + 1)::varchar as name, {_COSINE} as score from embeddings e, q where {_COSINE} >= 0.45 order by score desc, id limit 5),
b as (select id, name from (select *, row_number() over (partition by name order by score desc, id) as r from s) where r = 1 order by score desc, id limit 2),
m as (select distinct 'o' || l_orderkey as id, 'p' || l_partkey as node, p_name as name from lineitem join part on l_partkey = p_partkey),
t as (select id, string_agg(name, '、' order by node, name) as names from (select *, row_number() over (partition by id order by node, name) as r from m) where r <= 20 group by id),
h as (select distinct 'o' || o_orderkey as id, 'c' || o_custkey as node, c_name as name from orders join customer on o_custkey = c_custkey),
d as (select id, string_agg(name, '、' order by node, name) as names from (select *, row_number() over (partition by id order by node, name) as r from h) where r <= 10 group by id)
select b.id, b.name, coalesce(t.names, '') as "requiresMaterial", coalesce(d.names, '') as "handledBy" from b left join t on b.id = t.id left join d on b.id = d.id""")
def retrieve_single_shot(spark, sf):
    first = _first_vector(spark, sf)
    return retrieval.retrieve(_graph(spark, sf), "first", lambda text: first)["services"].select("id", "name", "requiresMaterial", "handledBy")


@query("""with r as (select *, row_number() over (partition by conv_id order by turn desc) as r from conversations), l as (select conv_id, turn, role || ': ' || substr(text, 1, 300) || case when length(text) > 300 then '…' else '' end as l from r where r <= 8)
select conv_id, string_agg(l, chr(10) order by turn) as history from l group by 1""")
def history_window(spark, sf):
    return retrieval.history(table(spark, sf, "conversations"))


@query()
def chunk_documents(spark, sf):
    return chunk.chunk_documents(spread(table(spark, sf, "documents")), "doc_id", "text").select("chunk_id", "doc_id", "chunk_no", "chunk_count", "title", F.md5("content").alias("digest"))


_CUT = f"list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([{chunk.SENTENCE_END}])', '\\1' || chr(1), 'g'), chr(1)), lambda x: regexp_replace(x, '^{tx.SPACE}+|{tx.SPACE}+$', '', 'g')), lambda x: x <> '')"


@query(f"with s as (select doc_id, {_CUT} as s from documents) select doc_id, n::int - 1 as n, md5(s[n]) as sentence from s, unnest(range(1, len(s) + 1)) as u(n)")
def sentence_units(spark, sf):
    return chunk.sentences(spread(table(spark, sf, "documents")), "doc_id", "text").withColumn("sentence", F.md5("sentence"))


@query("select doc_id, source from (select *, row_number() over (partition by source order by md5(doc_id || '|42'), doc_id) as r from documents) where r <= 10")
def stratified_sample(spark, sf):
    return sample.stratified(table(spark, sf, "documents").select("doc_id", "source"), ["source"], "doc_id", 10, 42)


@query("select doc_id, lang from (select d.*, row_number() over (partition by lang order by (case when l.quality is null then 0 else 1 + l.quality end) desc, md5(d.doc_id || '|7'), d.doc_id) as r from documents d left join labels l on d.doc_id = l.doc_id) where r <= 25")
def score_tier_sample(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return sample.best_tiers(docs, "lang", F.when(F.col("quality").isNull(), 0).otherwise(1 + F.col("quality")), "doc_id", 25, 7).select("doc_id", "lang")


@query("""with t as (select *, row_number() over (partition by lang, source order by md5(doc_id || '|3'), doc_id) as turn from documents), u as (select *, row_number() over (partition by lang order by turn, source) as r from t where turn <= 30)
select doc_id, lang, source, turn::int as turn from u where r <= 30""")
def round_robin_pick(spark, sf):
    return sample.round_robin(table(spark, sf, "documents").select("doc_id", "lang", "source"), "lang", "source", "doc_id", 30, 3)


@query("""with n as (select lang, count(*) as n, sum(count(*)) over () as total from documents group by lang),
b as (select *, least(n, greatest(1, 100 * n // total)) as base, row_number() over (order by 100 * n % total desc, n desc, lang) as place from n),
q as (select lang, case when total <= 100 then n else base + (place <= 100 - sum(base) over ())::int end as quota from b)
select doc_id, lang from (select d.doc_id, d.lang, q.quota, row_number() over (partition by d.lang order by md5(d.doc_id || '|5'), d.doc_id) as r from documents d join q on d.lang is not distinct from q.lang) where r <= quota""")
def quota_sample(spark, sf):
    return sample.with_quotas(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id", 100, 5)


def _answers(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Users' turns as gold, the next turn as the answer; every ninth answer is missing."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    gold = turns.where("role = 'user'").select(F.concat_ws("-", "conv_id", "turn").alias("test_id"), F.col("text").alias("expected_answer"), F.concat(F.lit("d"), F.col("conv_id") % 3).alias("dataset"), F.concat(F.lit("t"), F.col("turn") % 4).alias("answer_type"))
    answers = turns.where("role <> 'user' and conv_id % 9 <> 0").select(F.concat_ws("-", "conv_id", F.col("turn") - 1).alias("test_id"), F.col("text").alias("answer"))
    return gold, answers


_PUNCT_FROM, _PUNCT_TO = "".join(tx.PUNCTUATION), "".join(tx.PUNCTUATION.values()).replace("'", "''")
_NORM = f"regexp_replace(regexp_replace(lower(translate(coalesce({{}}, ''), '{_PUNCT_FROM}', '{_PUNCT_TO}')), '@S+', ' ', 'g'), '^ | $', '', 'g')".replace("@S", tx.SPACE.replace("{", "{{").replace("}", "}}"))
_TOKENS = r"list_filter(regexp_extract_all({}, '[a-z0-9]+|[^a-z0-9\s]'), lambda t: regexp_matches(t, '^[\p{{L}}\p{{N}}]+$'))"
_SCORED = f"""with g as (select conv_id || '-' || turn as test_id, text as expected_answer, 'd' || (conv_id % 3) as dataset, 't' || (turn % 4) as answer_type from conversations where role = 'user'),
a as (select conv_id || '-' || (turn - 1) as k, text as answer from conversations where role <> 'user' and conv_id % 9 <> 0),
n as (select g.*, k, answer, {_NORM.format('answer')} as p, {_NORM.format('expected_answer')} as q from g left join a on test_id = k),
t as (select *, {_TOKENS.format('p')} as pt, {_TOKENS.format('q')} as qt from n),
s as (select test_id, dataset, answer_type, (p = q)::int as em, k is not null and trim(coalesce(answer, '')) <> '' as answered,
 coalesce(regexp_matches(answer, '{'|'.join(score.REFUSALS)}'), false) as refused, len(pt) + len(qt) as both_n, len(pt) as np, len(qt) as nq,
 coalesce(list_sum(list_transform(list_distinct(pt), lambda x: least(len(list_filter(pt, lambda y: y = x)), len(list_filter(qt, lambda y: y = x))))), 0) as same from t),
f as (select *, case when both_n = 0 then 1.0 when np = 0 or nq = 0 then 0.0 else 2.0::double * same / both_n end::double as f1 from s)"""


@query(_SCORED + " select test_id, em, answered, round(f1, 6) as f1 from f")
def em_f1_score(spark, sf):
    return score.score_answers(*map(spread, _answers(spark, sf)), ascii_only=True).select("test_id", "em", "answered", F.round("f1", 6).alias("f1"))


@query(_SCORED + """ select dataset, answer_type, count(*) as n, count(*) filter (answered) as answered, count(*) filter (refused) as refused, round(avg(em), 6) as em, round(avg(f1), 6) as f1,
 case when grouping(dataset) = 1 and grouping(answer_type) = 1 then 'all' when grouping(answer_type) = 1 then 'dataset' when grouping(dataset) = 1 then 'answer_type' else 'dataset+answer_type' end as level
from f group by grouping sets ((), (dataset), (answer_type), (dataset, answer_type))""")
def score_grouping_sets(spark, sf):
    return score.summarise(score.score_answers(*map(spread, _answers(spark, sf)), ascii_only=True))


_SMALL, _LARGE = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@query(f"""with t as (select turn % 5 as block, text, conv_id * 100 + turn as seq, role, conv_id from conversations),
u as (select block, {_NORM.format('text')} as norm, seq from t where role = 'user'),
b as (select block, {_NORM.format('text')} as norm, seq from t where role = 'assistant' union all select block, {_NORM.format(f"translate(text, '{_SMALL}', '{_LARGE}')")}, seq from t where role = 'user' and conv_id % 3 = 0),
x as (select *, row_number() over (partition by block, norm order by seq) as r from u), y as (select *, row_number() over (partition by block, norm order by seq) as r from b)
select coalesce(x.block, y.block) as block, count(*) filter (x.seq is not null and y.seq is not null) as matched, count(*) filter (y.seq is null) as only_left, count(*) filter (x.seq is null) as only_right
from x full outer join y on x.block = y.block and x.norm = y.norm and x.r = y.r group by 1""")
def bag_match_ab(spark, sf):
    """Whole normalised texts of users' and assistants' turns; so that some match, the right side also holds every third conversation's user turns, in capitals."""
    turns = table(spark, sf, "conversations").select((F.col("turn") % 5).alias("block"), "text", (F.col("conv_id") * 100 + F.col("turn")).alias("seq"), "role", "conv_id")
    normal = lambda df: spread(df).select("block", tx.scoring_normal("text", ascii_only=True).alias("norm"), "seq")
    users, again = turns.where("role = 'user'"), turns.where("role = 'user' and conv_id % 3 = 0").withColumn("text", F.translate("text", _SMALL, _LARGE))
    met = dedup.bag_match(normal(users), normal(turns.where("role = 'assistant'").unionByName(again)), ["block", "norm"], "seq")
    left, right = F.col("left_seq").isNotNull(), F.col("right_seq").isNotNull()
    return met.groupBy("block").agg(F.count_if(left & right).alias("matched"), F.count_if(left & ~right).alias("only_left"), F.count_if(~left & right).alias("only_right"))


@query("""with a as (select distinct conv_id from conversations where role = 'assistant'), s as (select distinct conv_id from conversations where role = 'system')
select case when s.conv_id is null then 'left' when a.conv_id is null then 'right' else 'both' end as side, count(*) as n from a full outer join s on a.conv_id = s.conv_id group by 1""")
def alignment_sides(spark, sf):
    turns = table(spark, sf, "conversations")
    return score.alignment(turns.where("role = 'assistant'"), turns.where("role = 'system'"), "conv_id").groupBy("side").agg(F.count("*").alias("n"))


@query("select lang, count(*) as n, " + ", ".join(f"quantile_disc(n_chars, {p / 100}) as p{p}" for p in (25, 50, 75, 90, 99)) + " from documents group by lang")
def length_percentiles(spark, sf):
    return score.percentiles(table(spark, sf, "documents"), ["lang"], "n_chars")


@query("select event_type, count(*) filter (user_id % 2 = 0) as a, count(*) filter (user_id % 2 <> 0) as b, count(*) filter (user_id % 2 = 0) - count(*) filter (user_id % 2 <> 0) as diff from events group by 1")
def predicate_distribution(spark, sf):
    return score.distribution(table(spark, sf, "events"), F.col("user_id") % 2 == 0, "event_type")


_FIELDS = {"license": ("licen[sc]ed", "rights reserved"), "contact": ("@", "\\(555\\)"), "secret": ("token", "password")}


@query("select field, count(*) as n from (select case when regexp_matches(text, 'licen[sc]ed|rights reserved') then 'license' when regexp_matches(text, '@|\\(555\\)') then 'contact' when regexp_matches(text, 'token|password') then 'secret' else 'other' end as field from documents) group by 1")
def source_field_rules(spark, sf):
    return spread(table(spark, sf, "documents")).groupBy(propositions.source_field(F.col("text"), _FIELDS).alias("field")).agg(F.count("*").alias("n"))


@query("select coalesce(nullif(source, ''), '(空)') as topic, count(*) as n from documents group by 1 order by n desc, topic limit 20")
def top_k_counts(spark, sf):
    docs = table(spark, sf, "documents").groupBy(F.coalesce(F.nullif("source", F.lit("")), F.lit("(空)")).alias("topic")).agg(F.count("*").alias("n"))
    return docs.orderBy(F.desc("n"), "topic").limit(20)


@query("select o_orderkey, o_orderpriority, row_number() over (partition by o_custkey order by try_cast(regexp_extract(o_orderpriority, '^[0-9]+') as int) nulls last, o_orderkey)::int as place from orders")
def order_key_sort(spark, sf):
    number = F.nullif(F.regexp_extract("o_orderpriority", "^[0-9]+", 0), F.lit("")).try_cast("int")
    return table(spark, sf, "orders").withColumn("place", F.row_number().over(Window.partitionBy("o_custkey").orderBy(number.asc_nulls_last(), "o_orderkey"))).select("o_orderkey", "o_orderpriority", "place")


@query("select event_id, event_type from events where event_id not in (select event_id from events where event_type = 'error' or event_id % 3 = 0)")
def resume_antijoin(spark, sf):
    """Events that an earlier run has not done: it had written every third and all errors."""
    events = table(spark, sf, "events")
    return state.pending(events, events.where("event_type = 'error' or event_id % 3 = 0"), "event_id").select("event_id", "event_type")


_STATE = "case event_type when 'view' then 'UPLOADING' when 'click' then 'UPLOADED' when 'purchase' then 'SUBMITTED' when 'signup' then 'SUCCESS' else 'odd' end"


@query(f"""with s as (select user_id as job, (event_id % 3)::int as part, {_STATE} as state from events), r as (select *, case state when 'UPLOADING' then 1 when 'UPLOADED' then 2 when 'SUBMITTED' then 3 when 'SUCCESS' then 4 else 0 end as rank from s)
select job, part, max_by(state, rank) as state, max(rank)::int as rank from r group by all""")
def state_max_rank(spark, sf):
    parts = table(spark, sf, "events").select(F.col("user_id").alias("job"), (F.col("event_id") % 3).cast("int").alias("part"), F.expr(_STATE).alias("state"))
    return state.merged(parts, ["job", "part"])


@query("""with a as (select n_nationkey as k from nation), b as (select c_nationkey as k from customer where c_acctbal > 9000)
select 'intersect' as op, count(*) as n from (select k from a intersect select k from b) union all select 'except', count(*) from (select k from a except select k from b) union all select 'union', count(*) from (select k from a union select k from b)
union all select 'bag_intersect', count(*) from (select k from b intersect all select c_nationkey from customer where c_acctbal < 0) union all select 'bag_except', count(*) from (select k from b except all select c_nationkey from customer where c_acctbal < 0)""")
def set_operations(spark, sf):
    customer = table(spark, sf, "customer")
    a, b, c = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k")), customer.where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")), customer.where("c_acctbal < 0").select(F.col("c_nationkey").alias("k"))
    out = None
    for op, df in (("intersect", a.intersect(b)), ("except", a.subtract(b)), ("union", a.union(b).distinct()), ("bag_intersect", b.intersectAll(c)), ("bag_except", b.exceptAll(c))):
        row = df.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query()
def canonical_nfkc(spark, sf):
    return spread(table(spark, sf, "documents")).select("doc_id", F.md5(tx.canonical("text")).alias("digest"))


@query("""with recursive l as (select source, doc_id, to_json({'doc_id': doc_id, 'lang': lang, 'text': text})::varchar || chr(10) as line from documents),
c as (select *, strlen(line) as n, sum(strlen(line)) over (partition by source order by doc_id) as ends, row_number() over (partition by source order by doc_id) as r from l),
p as (select source, 1 as part, 1::bigint as first, 0::hugeint as before from c where r = 1
 union all select p.source, p.part + 1, min(c.r), min(c.ends - c.n) from p join c on c.source = p.source and c.r > p.first and c.ends - p.before > 64000 group by p.source, p.part),
f as (select *, coalesce(lead(first) over (partition by source order by part), 1::bigint << 60) as upto from p)
select f.source, f.part::int as part, count(*) as rows, sum(n)::bigint as bytes, sha256(string_agg(line, '' order by r)) as sha256 from f join c on c.source = f.source and c.r >= f.first and c.r < f.upto group by f.source, f.part""")
def byte_shards(spark, sf):
    lines = table(spark, sf, "documents").select("source", "doc_id", F.to_json(F.struct("doc_id", "lang", "text")).alias("line"))
    return sinks.byte_parts(lines, "source", "doc_id", "line", 64_000, 350_000)


@query(f"""with d as (select doc_id, doc_id % 2 = 0 as is_condition, unnest(list_transform(string_split(regexp_replace(text, '\\.[ \\t\\n\\x0B\\f\\r]', '.' || chr(1), 'g'), chr(1)), lambda s, k: {{'k': k, 's': regexp_replace(s, '^{tx.SPACE}+|{tx.SPACE}+$', '', 'g')}})) as x from documents where doc_id % 5 <> 0),
r as (select doc_id, is_condition, x.k as k, x.s as s, length(x.s) >= {propositions.LEAST} as good from d)
select doc_id as key, count(*) as raw, count(*) filter (k = 2) as invalid_predicate, count(*) filter (not good) as bad_statement, count(*) filter (good and is_condition and k > 1) as invalid_condition_type,
 count(distinct s) filter (good) as kept, count(*) - count(*) filter (not good) - count(distinct s) filter (good) as duplicate from r group by doc_id""")
def proposition_parse(spark, sf):
    """Replies made of all sentences of a document; every fifth is no JSON."""
    items = F.transform(F.split("text", r"(?<=\.)\s"), lambda s, k: F.struct(F.when(k == 0, "资格要求").when(k == 1, "unknown").otherwise("其他").alias("predicate"), s.alias("statement"), F.lit("x").alias("objectValue"), F.when(k == 0, "时间限制").otherwise("odd").alias("conditionType")))
    reply = F.when(F.col("doc_id") % 5 == 0, "no list").otherwise(F.concat(F.lit("```json\n"), F.to_json(items), F.lit("\n```")))
    replies = table(spark, sf, "documents").select("doc_id", reply.alias("reply"), F.when(F.col("doc_id") % 2 == 0, "condition").otherwise("process").alias("field"))
    return propositions.parse(replies, "doc_id", "reply", "field")[1]


def _stream(spark, sf, transform, mode: str = "append") -> DataFrame:
    """A stream over the events, run to its end in folders of its own, and what it wrote."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="quarry-")
    folder = f"{base}/stream-{spark.sparkContext._jvm.java.util.UUID.randomUUID()}"
    schema = table(spark, sf, "events").schema
    source = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    streams.run_to_end(transform(source), f"{folder}/out", f"{folder}/state", mode)
    return spark.read.parquet(f"{folder}/out")


@query("select time_bucket(interval 1 hour, ts) as start, event_type, count(*) as n, round(sum(value), 6) as total from events group by all")
def window_tumbling(spark, sf):
    return streams.tumbling(table(spark, sf, "events"), "1 hour")


@query("""select w as start, event_type, count(*) as n, round(sum(value), 6) as total from (select *, unnest([time_bucket(interval 30 minute, ts), time_bucket(interval 30 minute, ts) - interval 30 minute]) as w from events) group by all""")
def window_sliding(spark, sf):
    return streams.tumbling(table(spark, sf, "events"), "1 hour", slide="30 minutes")


@query("""with g as (select *, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minute then 0 else 1 end as new from events), s as (select *, sum(new) over (partition by user_id order by ts) as k from g)
select user_id, min(ts) as start, max(ts) + interval 30 minute as end, count(*) as n from s group by user_id, k""")
def window_session(spark, sf):
    return streams.sessions(table(spark, sf, "events"), "30 minutes")


@query("select user_id, event_type, count(*) as n from (select distinct event_id, user_id, event_type from events) group by all")
def stream_dedup(spark, sf):
    return _stream(spark, sf, lambda s: streams.dedup_stream(s, ["event_id"], "3650 days")).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("""select time_bucket(interval 1 hour, ts) as start, event_type, count(*) as n, round(sum(value), 6) as total from events
group by all having time_bucket(interval 1 hour, min(ts)) + interval 1 hour <= (select max(ts) - interval 10 minute from events)""")
def stream_tumbling(spark, sf):
    """Windows that the watermark has closed when the stream ends."""
    return _stream(spark, sf, lambda s: streams.tumbling(s, "1 hour", "10 minutes"))
