"""Node and edge tables: concepts, shared nodes, citations, step order, multi-value cells, routing, upserts and counts."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.text import display_name, split_values, squeeze, strip
from .dedup import first_wins

# Kinds of matters that are administrative powers, and legal persons.
ADMIN_POWER = ("行政许可", "行政处罚", "行政强制", "行政征收", "行政给付", "行政检查", "行政确认", "行政奖励", "行政裁决", "其他行政权力")
LEGAL_PERSON = ("企业法人", "事业法人", "社会组织法人")


def affair_concept(c: Column) -> Column:
    return F.when(c.isin(*ADMIN_POWER), F.concat(F.lit("行政权力-"), c)).otherwise(c)


def target_concept(c: Column) -> Column:
    return F.when(c.isin(*LEGAL_PERSON), F.concat(F.lit("法人-"), c)).otherwise(c)


def with_ancestors(concepts: DataFrame, column: str, separator: str = "-") -> DataFrame:
    """id and parent of every concept and of all its ancestors; an id is its path."""
    parts = F.split(column, separator)
    each = concepts.select(parts.alias("p")).select("p", F.explode(F.sequence(F.lit(1), F.size("p"))).alias("n"))
    join = lambda n: F.array_join(F.slice("p", F.lit(1), n), separator)
    return each.select(join(F.col("n")).alias("id"), F.when(F.col("n") > 1, join(F.col("n") - 1)).alias("parent")).distinct()


def concepts_first_seen(df: DataFrame, kind: str, column: Column, seq: str) -> DataFrame:
    """kind, id, first: the distinct concepts of a multi-value cell and where each is seen first."""
    return df.select(F.explode(column).alias("id"), seq).where("id <> ''").groupBy("id").agg(F.min(seq).alias("first")).select(F.lit(kind).alias("kind"), "id", "first")


def edges_of_cell(df: DataFrame, source: str, cell: str, rel: str) -> DataFrame:
    """Edges that a cell of several values stands for, without empty and repeated values."""
    return df.select(F.col(source).alias("src"), F.lit(rel).alias("rel"), F.explode(split_values(cell)).alias("dst"))


def next_edges(df: DataFrame, parent: str, order: Sequence[str], node: str) -> DataFrame:
    """An edge from each node to the next one of its parent."""
    nxt = F.lead(node).over(Window.partitionBy(parent).orderBy(*order))
    return df.select(F.col(node).alias("src"), nxt.alias("dst")).where("dst is not null")


def share_nodes(df: DataFrame, name: Column, canonical: Column, prefix: str, old_id: str, seq: str, length: int = 16) -> tuple[DataFrame, DataFrame]:
    """Nodes that are the same after canonicalisation, as one: (id, name, merged), and (old_id, new_id)."""
    new = F.concat(F.lit(f"{prefix}-"), F.substring(F.md5(canonical), 1, length))
    rows = df.select(F.col(old_id).alias("old_id"), F.col(seq).alias("seq"), name.alias("name"), new.alias("new_id"))
    nodes = rows.groupBy("new_id").agg(F.min_by("name", F.struct("seq", "name")).alias("name"), F.count_distinct("old_id").alias("merged"))
    return nodes.select(F.col("new_id").alias("id"), "name", "merged"), rows.groupBy("old_id").agg(F.min("new_id").alias("new_id"))


def rewrite_edges(edges: DataFrame, column: str, mapping: DataFrame, keep: str | None = None) -> DataFrame:
    """`edges` with new ids where the mapping has one, else the old; `keep` names a column for the old id. `mapped` says which."""
    joined = edges.join(mapping.withColumnRenamed("old_id", "__old"), F.col(column) == F.col("__old"), "left")
    out = joined.withColumn(keep, F.col(column)) if keep else joined
    return out.withColumn("mapped", F.col("new_id").isNotNull()).withColumn(column, F.coalesce("new_id", column)).drop("__old", "new_id")


def citations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows: seq, law, doc, article, content. (citations, bases) by canonical law, document and article: first values win, conflicts with the first are counted.

    A missing document number falls back to the law. Rows are counted by citation and text first, so that a law that is much
    cited is a few groups; conflicts are the rows whose text is not the first row's.
    """
    keyed = rows.select("seq", "law", "article", "content", F.coalesce(F.nullif("doc", F.lit("")), F.col("law")).alias("doc_key"), (F.coalesce("doc", F.lit("")) == "").alias("fallback"))
    keyed = keyed.withColumn("basis_id", ids.hashed_id("LB", "law", "doc_key", length=16)).withColumn("citation_id", ids.hashed_id("LC", "law", "doc_key", "article", length=16)).withColumn("digest", F.md5(F.coalesce("content", F.lit(""))))
    digests = keyed.groupBy("citation_id", "digest").agg(F.count("*").alias("n"), F.min(F.struct("seq", "basis_id", "law", "article")).alias("first"))
    cited = digests.groupBy("citation_id").agg(F.sum("n").alias("sources"), F.min(F.struct("first", "n")).alias("f"))
    cited = cited.select("citation_id", F.col("f.first.basis_id").alias("basis_id"), display_name("f.first.law", "f.first.article").alias("name"), "sources", (F.col("sources") - F.col("f.n")).alias("conflicts"))
    bases = keyed.groupBy("basis_id").agg(F.min_by("law", "seq").alias("law"), F.min_by("doc_key", "seq").alias("doc_no"), F.count("*").alias("sources"), F.count_if("fallback").alias("fallbacks"))
    return cited, bases


def dedup_edges(edges: DataFrame, order: Sequence[Column | str], keys: Sequence[str] = ("src", "dst")) -> DataFrame:
    return first_wins(edges, list(keys), list(order))


def routing(services: DataFrame, domain: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (type, id, name) and edges (src, rel, dst) of the routing layer: domain, categories of two levels, models."""
    rows = services.select(F.lit(domain).alias("domain"), squeeze("category_l1").alias("l1"), squeeze("category_l2").alias("l2"))
    seen = rows.distinct()
    dom, first, second = F.concat(F.lit("domain:"), "domain"), ids.category_id("domain", "l1"), ids.category_id("domain", F.concat_ws("/", "l1", "l2"))
    model = ids.model_id("domain", "l1")
    nodes = reduce(DataFrame.unionByName, (
        seen.select(F.lit("Domain").alias("type"), dom.alias("id"), F.col("domain").alias("name")),
        seen.select(F.lit("Category").alias("type"), first.alias("id"), F.col("l1").alias("name")),
        seen.where("l2 <> ''").select(F.lit("Category").alias("type"), second.alias("id"), F.col("l2").alias("name")),
        seen.select(F.lit("Model").alias("type"), model.alias("id"), F.col("l1").alias("name")),
    )).distinct()
    edges = reduce(DataFrame.unionByName, (
        seen.select(first.alias("src"), F.lit("belongsToDomain").alias("rel"), dom.alias("dst")),
        seen.where("l2 <> ''").select(second.alias("src"), F.lit("childOf").alias("rel"), first.alias("dst")),
        seen.select(model.alias("src"), F.lit("modelOf").alias("rel"), first.alias("dst")),
    )).distinct()
    return nodes, edges


def routing_tables(services: DataFrame, domain: str, name: str, scheme: str, entity_types: Sequence[str], relation_types: Sequence[str], version: str = "v1", schema_version: str = "v1", root: str = "根分类", other: str = "未分类") -> dict[str, DataFrame]:
    """The routing layer as four node, six relation and three service relation tables. services: service_id, category_l2.

    A domain has one scheme, a root category with a child for each distinct category, a base model and a profile for each child. Blank
    categories are `other`, rows without service_id are in no service relation. Two categories that get one id are an error.
    """
    spark = services.sparkSession
    text = lambda x: json.dumps(x, ensure_ascii=False, separators=(",", ":"))
    category, model = (lambda c: ids.category_id(F.lit(domain), c)), (lambda c: ids.model_id(F.lit(domain), c))
    own = F.coalesce(F.nullif(strip("category_l2"), F.lit("")), F.lit(other))
    names = services.select(own.alias("name")).distinct()
    clash = names.groupBy(category("name").alias("id")).agg(F.count("*").alias("n"), F.min("name").alias("name")).where("n > 1").limit(5).collect()
    if clash:
        raise ValueError(f"categories with one id: {[r.name for r in clash]}")
    one, active = spark.range(1), F.lit("ACTIVE").alias("status")
    domain_id, v = F.lit(domain).alias("domain_id"), F.lit(version).alias("version")
    root_id, base_id = category(F.lit(root)), model(F.lit("base"))
    of = lambda c, a: F.lit(c).alias(a)
    node = lambda rows, cid, title, level, parent, about: rows.select(cid.alias("category_id"), title.alias("name"), of(level, "category_level"), parent.alias("parent_category_id"), of(scheme, "scheme_id"), domain_id, about.alias("description"), active, v)
    profile = lambda rows, mid, title, kind, cid, about, filters: rows.select(
        mid.alias("model_id"), title.alias("name"), of(kind, "model_type"), domain_id, cid.alias("category_id"), v, about.alias("description"), of(schema_version, "schema_version"),
        of(text(list(entity_types)), "enabled_entity_types"), of(text(list(relation_types)), "enabled_relation_types"), filters.alias("retrieval_filter"), of(text({"required": ["serviceId", "domainId", "categoryId"]}), "validation_profile"), active,
    )
    cid, mid, title = category("name"), model("name"), F.col("name")
    child_filter = F.concat(F.lit(text({"domain_id": domain})[:-1] + ',"category_id":'), F.to_json(F.struct(cid.alias("c"))).substr(F.lit(6), F.length(F.to_json(F.struct(cid.alias("c")))) - 6), F.lit("}"))
    edge = lambda rows, a, b: rows.select(a.alias("start_id"), b.alias("end_id"))
    d = F.lit(domain)
    used = services.where(strip("service_id") != "").select(strip("service_id").alias("sid"), own.alias("name"))
    return {
        "service_domains": one.select(domain_id, of(name, "name"), of(f"{name}政务服务领域统一知识模型", "description"), active, v),
        "category_schemes": one.select(of(scheme, "scheme_id"), of(f"{name}分类体系", "name"), domain_id, of(f"{name}的分类体系", "description"), v),
        "service_categories": node(one, root_id, F.lit(name), "1", F.lit(""), F.lit(f"{name}根分类")).unionByName(node(names, cid, title, "2", root_id, F.concat(F.lit(f"{name}："), title))),
        "knowledge_models": profile(one, base_id, F.lit(f"{name}基础知识模型"), "DOMAIN_BASE", F.lit(""), F.lit(f"{name}共享基础模型"), F.lit(text({"domain_id": domain}))).unionByName(
            profile(names, mid, F.concat(F.lit(f"{name}-"), title, F.lit("知识模型")), "CATEGORY_PROFILE", cid, F.concat(F.lit(f"面向{name}“"), title, F.lit("”分类的知识模型 Profile")), child_filter)
        ),
        "category_parent": edge(names, cid, root_id),
        "category_belongs_to_scheme": edge(one, root_id, F.lit(scheme)).unionByName(edge(names, cid, F.lit(scheme))),
        "category_belongs_to_domain": edge(one, root_id, d).unionByName(edge(names, cid, d)),
        "model_applies_to_category": edge(names, mid, cid),
        "model_belongs_to_domain": edge(one, base_id, d).unionByName(edge(names, mid, d)),
        "model_extends_model": edge(names, mid, base_id),
        "service_belongs_to_domain": edge(used, F.col("sid"), d),
        "service_classified_as": edge(used, F.col("sid"), cid),
        "service_uses_model": edge(used, F.col("sid"), mid),
    }


def id_collisions(nodes: DataFrame) -> DataFrame:
    """Ids that stand for more than one name."""
    return nodes.groupBy("type", "id").agg(F.count_distinct("name").alias("names")).where("names > 1")


def reconcile(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, expected, actual, diff, ok: counts of two tables side by side; a side without a key counts 0."""
    a = expected.select(*keys, F.col("n").alias("expected"), F.lit(0).cast("long").alias("actual"))
    b = actual.select(*keys, F.lit(0).cast("long").alias("expected"), F.col("n").alias("actual"))
    both = a.unionByName(b).groupBy(*keys).agg(F.sum("expected").alias("expected"), F.sum("actual").alias("actual"))
    return both.withColumn("diff", F.col("actual") - F.col("expected")).withColumn("ok", F.col("diff") == 0)


def adapt(records: DataFrame) -> dict[str, DataFrame]:
    """Node and edge tables of unified records, each an explosion of the same frame; persist it where it is not a table.

    records: seq, code, name, org, url, affair_type, targets, levels, theme, file_stem, count, and arrays of structs steps
    (step, link, handler), results (name, kind), materials (name, seq), laws (name, doc, article, content); null elements keep
    their place in the numbering.
    """
    base = records.select("*", squeeze("code").alias("__code"), squeeze("name").alias("__name"), squeeze("org").alias("__org"))
    own = F.when(F.col("__code") != "", F.col("__code")).otherwise(ids.hashed_id("GA", "__name", "__org", "url"))
    base = first_wins(base.withColumn("aid", own), ["aid"], ["seq"])
    stem_theme = F.when(F.regexp_like("file_stem", F.lit("^[一-龥]")), F.col("file_stem")).otherwise("")
    theme = F.when(squeeze("theme") == "", stem_theme).otherwise(squeeze("theme"))

    def parts(column: str) -> DataFrame:
        return base.select("aid", "seq", F.posexplode(column).alias("pos", "x")).where("x is not null").withColumn("nr", F.col("pos") + 1)

    named = lambda *cs, default: F.coalesce(*(F.nullif(squeeze(c), F.lit("")) for c in cs), default)
    steps = parts("steps").select("aid", "pos", ids.ordinal_id("aid", "P", F.col("nr")).alias("id"), named("x.step", "x.link", default=F.concat(F.lit("环节"), "nr")).alias("name"), F.col("nr").alias("step_index"))
    results = parts("results").select("aid", "pos", ids.ordinal_id("aid", "R", F.col("nr")).alias("id"), named("x.name", default=F.concat(F.lit("办理结果"), "nr")).alias("name"), squeeze("x.kind").alias("kind"))
    materials = parts("materials").select("aid", "seq", "pos", squeeze("x.name").alias("dst"), squeeze("x.seq").alias("order_no")).where("dst <> ''")
    laws = parts("laws").select("aid", "seq", "pos", squeeze("x.name").alias("title"), squeeze("x.doc").alias("doc"), squeeze("x.article").alias("article"), F.coalesce("x.content", F.lit("")).alias("content")).where("title <> '' or doc <> ''")
    laws = laws.withColumn("basis_id", F.when(F.col("doc") != "", F.col("doc")).otherwise(ids.hashed_id("LH", "title"))).withColumn("citation_id", ids.hashed_id("LC", "basis_id", "article"))
    cited = first_wins(laws, ["citation_id"], ["seq", "pos"])
    name = F.trim(F.concat_ws(" ", "title", "article"))
    return {
        "Affair": base.select(F.col("aid").alias("id"), F.col("__name").alias("name"), affair_concept(squeeze("affair_type")).alias("affair_type"), F.array_join(F.transform(split_values("targets"), target_concept), ",").alias("targets"), F.array_join(split_values("levels", "[,，;；]+"), ",").alias("levels"), theme.alias("theme"), F.col("__org").alias("org")),
        "ImplementingOrg": base.where("__org <> ''").select(F.col("__org").alias("id"), F.col("__org").alias("name")).distinct(),
        "Material": materials.select(F.col("dst").alias("id"), F.col("dst").alias("name")).distinct(),
        "LegalBasis": first_wins(laws, ["basis_id"], ["seq", "pos"]).select(F.col("basis_id").alias("id"), "title", "doc"),
        "LegalCitation": cited.select(F.col("citation_id").alias("id"), F.when(name == "", F.col("basis_id")).otherwise(name).alias("name"), "article", "content"),
        "ProcessStep": steps.drop("pos"),
        "ResultDocument": results.drop("pos"),
        "Affair_requireMaterial_Material": materials.select(F.col("aid").alias("src"), "dst", "order_no"),
        "Affair_citeLegal_LegalCitation": laws.select(F.col("aid").alias("src"), F.col("citation_id").alias("dst")),
        "LegalCitation_partOf_LegalBasis": cited.select(F.col("citation_id").alias("src"), F.col("basis_id").alias("dst")),
        "ProcessStep_nextStep_ProcessStep": next_edges(steps, "aid", ["pos"], "id"),
        "Concept": concepts_first_seen(base, "ServiceTarget", F.transform(split_values("targets"), target_concept), "seq").unionByName(concepts_first_seen(base, "AffairType", F.array(affair_concept(squeeze("affair_type"))), "seq")).unionByName(concepts_first_seen(base, "ExerciseLevel", split_values("levels", "[,，;；]+"), "seq")).unionByName(concepts_first_seen(base.withColumn("__theme", theme), "ThemeCategory", F.array("__theme"), "seq")),
    }
