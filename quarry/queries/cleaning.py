"""Cleaning, validation, deduplication, profiling and merging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import dedup, profile, unify, validate
from .base import register, spread, table

SPACE = tx.SPACE


QUERIES: dict = {}
SQL: dict[str, str] = {}
query = register(QUERIES, SQL)


UNESCAPED = "{x}"
for _ in range(3):
    for _name, _char in tx.ENTITIES:
        UNESCAPED = f"replace({UNESCAPED}, '{_name}', '{_char.replace(chr(39), chr(39) * 2)}')"


def _clean_sql(c: str) -> str:
    plain = f"regexp_replace(regexp_replace({UNESCAPED.format(x=c)}, '{tx.BREAK_TAG}', chr(10), 'g'), '{tx.ANY_TAG}', '', 'g')"
    text = f"case when contains({c}, '&') or contains({c}, '<') then {plain} else {c} end"
    text = f"replace(regexp_replace({text}, '\\r\\n?', chr(10), 'g'), chr(9), ' ')"
    return f"regexp_replace(regexp_replace({text}, '{tx.CONTROLS}', '', 'g'), '^{SPACE}+|{SPACE}+$', '', 'g')"


def _squeeze_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({c}, ''), '{SPACE}+', ' ', 'g'), '^ | $', '', 'g')"


@query(f"select page_id, md5({_clean_sql('html')}) as digest, length({_clean_sql('html')})::int as n from pages")
def clean_html_text(spark, sf):
    text = tx.clean("html")
    return spread(table(spark, sf, "pages")).select("page_id", F.md5(text).alias("digest"), F.length(text).alias("n"))


@query(f"select doc_id, md5({_squeeze_sql('text')}) as digest, length({_squeeze_sql('text')})::int as n from documents")
def squeeze_text(spark, sf):
    return spread(table(spark, sf, "documents")).select("doc_id", F.md5(tx.squeeze("text")).alias("digest"), F.length(tx.squeeze("text")).alias("n"))


_LINES = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), '[ \t\f\x0b]+', ' ', 'g'), '(?m)^ | $', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"


@query(f"select doc_id, md5({_LINES}) as digest from documents")
def normalize_whitespace(spark, sf):
    return spread(table(spark, sf, "documents")).select("doc_id", F.md5(tx.lines_normal("text")).alias("digest"))


def _reason():
    return validate.first_reason([
        ("empty_text", tx.blank("text")),
        ("too_short", F.length("text") < 40),
        ("no_letters", ~F.regexp_like("text", F.lit("[a-zA-Z]"))),
        ("unknown_lang", ~F.coalesce(F.col("lang").isin("en", "de", "fr", "es"), F.lit(False))),
    ])


_REASON = f"""case when regexp_replace(coalesce(text, ''), '^{SPACE}+|{SPACE}+$', '', 'g') = '' then 'empty_text' when length(text) < 40 then 'too_short'
    when not regexp_matches(text, '[a-zA-Z]') then 'no_letters' when lang is null or lang not in ('en', 'de', 'fr', 'es') then 'unknown_lang' end"""


@query(f"select coalesce(reason, 'ok') as reason, count(*) as n, min(doc_id) as first_doc from (select doc_id, {_REASON} as reason from documents) group by 1")
def reject_cascade(spark, sf):
    tagged = spread(table(spark, sf, "documents")).select("doc_id", _reason().alias("reason"))
    return tagged.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query("select doc_id, lang, md5(text) as key from (select *, row_number() over (partition by md5(text) order by doc_id) as r from documents) where r = 1")
def dedup_first_wins(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.md5("text").alias("key"))
    return dedup.first_wins(docs, ["key"], ["doc_id"])


@query("""with x as (select d.doc_id, md5(d.text) as key, l.quality from documents d left join labels l on d.doc_id = l.doc_id)
select key, doc_id, coalesce(quality, -1) as quality, position from (select *, row_number() over (partition by key order by quality is null, doc_id) as r, min(doc_id) over (partition by key) as position from x) where r = 1""")
def dedup_prefer_nonempty(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("key")).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    out = dedup.prefer_filled(docs, ["key"], F.col("quality").isNotNull(), "doc_id")
    return out.withColumn("quality", F.coalesce("quality", F.lit(-1)))


@query("select doc_id, key, n as occurrences from (select doc_id, md5(text) as key, count(*) over (partition by md5(text)) as n, row_number() over (partition by md5(text) order by doc_id) as r from documents) where r = 1")
def occurrence_backfill(spark, sf):
    return dedup.with_occurrences(table(spark, sf, "documents").select("doc_id", F.md5("text").alias("key")), "key", "doc_id")


@query("select md5(text) as key, count(distinct source) as groups, count(*) as rows, count(*) - 1 as surplus from documents group by 1 having count(distinct source) > 1")
def cross_partition_dups(spark, sf):
    return dedup.across_groups(table(spark, sf, "documents").select("source", F.md5("text").alias("h")), F.col("h"), "source")


@query("""with d as (select md5(text) as key, doc_id, coalesce(source, '') as topic, length(text) as n, lang from documents where text is not null),
a as (select key, min(doc_id) as doc_id, min_by(topic, doc_id) as topic, min_by(n, doc_id) as n from d where lang = 'en' group by key),
b as (select key, max(doc_id) as doc_id, max_by('', doc_id) as topic, max_by(n, doc_id) as n from d group by key)
select coalesce(a.key, b.key) as key,
 case when b.key is null or a.n >= b.n then a.doc_id else b.doc_id end as doc_id,
 case when b.key is null or a.n >= b.n then a.n else b.n end::int as n,
 coalesce(nullif(case when b.key is null or a.n >= b.n then a.topic else b.topic end, ''), nullif(case when b.key is null or a.n >= b.n then b.topic else a.topic end, ''), '') as topic,
 concat_ws('+', case when a.key is not null then 'first' end, case when b.key is not null then 'last' end) as sources
from a full outer join b on a.key = b.key""")
def cross_source_merge(spark, sf):
    docs = table(spark, sf, "documents").where("text is not null").select(F.md5("text").alias("key"), "doc_id", F.coalesce("source", F.lit("")).alias("topic"), F.length("text").alias("n"), "lang")
    first = docs.where("lang = 'en'").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.min_by("n", "doc_id").alias("n"), F.min_by("topic", "doc_id").alias("topic"))
    last = docs.groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.max_by("n", "doc_id").alias("n"), F.lit("").alias("topic"))
    out = unify.merge_sources(first, last, "key", F.col("n"), "topic", ("first", "last"))
    return out.withColumn("sources", F.array_join("sources", "+"))


_LEDGER = f"""with t as (select lang, doc_id, {_REASON} as reason, md5({_squeeze_sql('text')}) as key from documents),
c as (select *, reason is null and row_number() over (partition by reason is null, key order by doc_id) > 1 as dup from t)
select @by count(*) as rows_in, count(*) filter (reason is null and not dup) as kept, count(*) filter (reason is null and dup) as duplicates, count(*) filter (reason is not null) as rejects, true as closes from c @group"""


def _tagged(spark, sf) -> DataFrame:
    return spread(table(spark, sf, "documents")).select("lang", "doc_id", _reason().alias("reason"), F.md5(tx.squeeze("text")).alias("key"))


@query(_LEDGER.replace("@by", "lang,").replace("@group", "group by lang"))
def clean_dedup_ledger(spark, sf):
    """Validated, cleaned and deduplicated documents, accounted for by language."""
    return validate.ledger_by_key(_tagged(spark, sf), "reason", "key", "doc_id", ["lang"])


@query(_LEDGER.replace("@by", "").replace("@group", ""))
def ledger_closure(spark, sf):
    return validate.ledger_by_key(_tagged(spark, sf), "reason", "key", "doc_id")


@query("""with c as (select o.*, l.quality, l.toxic from documents o left join labels l on o.doc_id = l.doc_id), n as (select count(*) as total, count(*) filter (trim(text) = '' or text is null) as e1, count(*) filter (quality is null) as e2, count(*) filter (toxic is null) as e3, count(*) filter (lang is null or trim(lang) = '') as e4 from c),
f as (select unnest(['text', 'quality', 'toxic', 'lang']) as field, total, unnest([e1, e2, e3, e4]) as empty from n)
select field, total, empty, round(empty / total, 6) as rate from f where total >= 100 order by rate desc, total desc, field limit 20""")
def field_empty_rate(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return profile.empty_rates(docs, ["text", "quality", "toxic", "lang"])


@query("""select d.source, count(*) as rows, round(avg(case when l.quality is null then 0.0 else 1.0 end), 6) as fill_quality, round(avg(case when d.lang is null or trim(d.lang) = '' then 0.0 else 1.0 end), 6) as fill_lang
from documents d left join labels l on d.doc_id = l.doc_id group by d.source""")
def fill_rates(spark, sf):
    return profile.fill_rates(table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left"), ["quality", "lang"], ["source"])


@query("""(select 'text' as field, doc_id as seq, length(coalesce(text, ''))::bigint as length from documents order by length desc, seq limit 1)
union all (select 'html', page_id, length(coalesce(html, ''))::bigint as length from pages order by length desc, page_id limit 1)""")
def extremes_argmax(spark, sf):
    return profile.longest(table(spark, sf, "documents"), "text", "doc_id").unionByName(profile.longest(table(spark, sf, "pages"), "html", "page_id"))


@query(" union all ".join(f"select '{k}' as kind, count(*) filter (regexp_matches(html, '{p}')) as rows, coalesce(sum(len(regexp_extract_all(html, '{p}'))), 0)::bigint as hits from pages" for k, p in profile.RESIDUE.items()))
def residue_audit(spark, sf):
    return profile.residue(spread(table(spark, sf, "pages")), "html")


@query(f"select item, count(*) as count from (select unnest(regexp_extract_all(html, '{profile.RESIDUE['tag']}')) as item from pages) group by 1 order by count desc, item limit 25")
def residue_top_tags(spark, sf):
    return profile.residue_items(spread(table(spark, sf, "pages")), "html", "tag")


@query("with p as (select p_brand, p_type, count(*) as n from part group by all) select p_brand, count(*) as texts, sum(n)::bigint as rows, array_to_string(list_sort(list(p_type))[1:5], ';') as examples from p group by p_brand")
def code_text_pairs(spark, sf):
    return profile.code_text_pairs(table(spark, sf, "part"), "p_brand", "p_type")


@query("select event_id, (props::json->>'$.k')::int as k, event_type from events")
def json_props_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "struct<k:int>")["k"].alias("k"), "event_type")


@query("select split_part(k, ':', 1) as path, sum(n)::bigint as total, sum(e)::bigint as empty from (select 'k' as k, count(*) as n, count(*) filter (props::json->>'$.k' = '') as e from events where props is not null) group by 1")
def json_path_profile(spark, sf):
    return profile.json_paths(table(spark, sf, "events"), "props")


@query("""select event_id, case when event_type in ('purchase', 'signup') then 'v1' when value > 50 then 'v2' else 'none' end as variant,
 case when event_type in ('purchase', 'signup') then event_type || ':' || user_id when value > 50 then 'user:' || user_id else '' end as code from events""")
def variant_dispatch(spark, sf):
    first, second = F.col("event_type").isin("purchase", "signup"), F.col("value") > 50
    code = F.when(first, F.concat_ws(":", "event_type", "user_id")).when(second, F.concat(F.lit("user:"), "user_id")).otherwise("")
    return table(spark, sf, "events").select("event_id", F.when(first, "v1").when(second, "v2").otherwise("none").alias("variant"), code.alias("code"))


@query("select p_partkey, coalesce(nullif(case when p_size > 40 then '' else p_brand end, ''), nullif(p_type, ''), '') as label, substr(p_name, 1, 10) || case when length(p_name) > 10 then '…' else '' end as short from part")
def fallback_chain(spark, sf):
    brand = F.when(F.col("p_size") > 40, "").otherwise(F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", tx.first_filled(brand, "p_type").alias("label"), tx.cut("p_name", 10).alias("short"))


@query("select l_returnflag, l_linestatus, count(*) as n, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem where l_shipdate <= timestamp '1998-09-02' group by all")
def pricing_summary(spark, sf):
    items = table(spark, sf, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return items.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("""select o_orderkey, case when o_orderpriority is null or o_orderpriority = '' then '' else regexp_extract(o_orderpriority, '^[0-9]+') || '个' || 'day' end as term,
 case when o_totalprice > 100000 then '是' else '否' end as large from orders""")
def unit_and_flag_text(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", tx.with_unit(F.regexp_extract("o_orderpriority", "^[0-9]+", 0), F.lit("day")).alias("term"), tx.yes_no(F.col("o_totalprice") > 100000).alias("large"))
