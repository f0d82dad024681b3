"""Full context of services, and one-shot retrieval with what the chosen services don't cover.

The layered graph's nodes may hold more than a name (see FIELDS); columns that a table lacks are empty. Lists have bounds per
service, taken in a stated order, so that results do not depend on partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cut, unquote
from ..operators import traverse, vector
from ..operators.dedup import first_n, first_wins
from .hops import Graph

# Bounds of a service's lists, of texts, and the source fields whose chunks have a place of their own.
BOUNDS = {"requiresMaterial": 20, "hasProcessStep": 30, "citesLegal": 10, "handledBy": 5, "hasChannel": 6, "hasFee": 3, "hasFaq": 5, "hasChunk": 24}
MOST_TEXT, MOST_CITATION, MOST_CHANNEL, MOST_NOTE, EXTRA_CHUNKS = 600, 400, 120, 200, 6
OWN_FIELDS = ("acceptCondition", "windowProcess", "onlineProcess")
#: Columns of each type's nodes besides id and name.
FIELDS = {"step": ("time_limit",), "citation": ("article", "content"), "basis": ("doc_no",), "channel": ("channel_type", "service_time", "description"), "fee": ("fee_status", "fee_standard", "description"), "faq": ("answer",), "chunk": ("source_field", "content")}
FLOOR, BASIS_FLOOR = 0.45, 0.8
MATERIALS, CITATIONS, SERVICES = 4, 6, 2


def _text(c: str | Column) -> Column:
    """A value without quotes and white space around it; null is empty."""
    return F.coalesce(unquote(F.col(c) if isinstance(c, str) else c), F.lit(""))


def _nodes(graph: Graph, kind: str) -> DataFrame:
    nodes = graph.nodes[kind]
    wanted = ("name", *FIELDS.get(kind, ()))
    return nodes.select(F.col("id").alias("__node"), *((F.col(c) if c in nodes.columns else F.lit("")).cast("string").alias(c) for c in wanted))


def _edges(graph: Graph, rel: str) -> DataFrame:
    order = F.col("order_no") if "order_no" in graph.edges.columns else F.lit(None).cast("int")
    return graph.edges.where(F.col("rel") == rel).select("src", "dst", order.cast("double").alias("order_no"))


def _members(graph: Graph, chosen: DataFrame, rel: str) -> DataFrame:
    """id of the service, order_no, __node and the node's columns: the first of each service, by order, then by node."""
    kind = graph.model.relations[rel][1]
    pairs = _edges(graph, rel).join(chosen.select(F.col("id").alias("src")), "src", "left_semi").groupBy("src", "dst").agg(F.min("order_no").alias("order_no"))
    met = first_n(pairs, ["src"], [F.col("order_no").asc_nulls_last(), "dst"], BOUNDS[rel])
    return met.join(_nodes(graph, kind), F.col("dst") == F.col("__node")).withColumnRenamed("src", "id")


def _listed(rows: DataFrame, name: str, *values: Column) -> DataFrame:
    """id and the list `name` of structs of `values`, in order."""
    place = F.struct(F.coalesce("order_no", F.lit(float("inf"))).alias("o"), F.col("__node").alias("n"), F.struct(*values).alias("v"))
    return rows.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(place)), lambda x: x["v"]).alias(name))  # bounded by BOUNDS


def cited(graph: Graph, rows: DataFrame) -> DataFrame:
    """`rows` with __node a citation: its article, content, basis and doc_no."""
    part = _edges(graph, "partOf").select(F.col("src").alias("__c"), F.col("dst").alias("__b"))
    basis = _nodes(graph, "basis").select(F.col("__node").alias("__b"), F.col("name").alias("__basis"), "doc_no")
    first = first_wins(part.join(basis, "__b"), ["__c"], ["__b"])
    met = rows.join(first, F.col("__node") == F.col("__c"), "left")
    return met.withColumns({"article": _text("article"), "content": cut(_text("content"), MOST_CITATION), "basis": _text("__basis"), "doc_no": _text("doc_no")}).drop("__c", "__b", "__basis")


def citation_key(shared_ids: bool) -> Column:
    """What equal citations are known by: their id where ids are shared, else article and basis."""
    both = F.concat("article", "basis")
    return F.coalesce(F.nullif(_text("__node"), F.lit("")), both) if shared_ids else both


def service_context(graph: Graph, chosen: DataFrame) -> DataFrame:
    """id, name and the lists of each chosen service (id, name): materials, steps, citations, departments, channels, fees, faqs, chunks; and a text for each of OWN_FIELDS."""
    rel = lambda name: _members(graph, chosen, name)
    chunks = rel("hasChunk").withColumn("content", _text("content")).where("content <> ''").withColumn("field", _text("source_field"))
    own = chunks.where(F.col("field").isin(*OWN_FIELDS))
    texts = [_listed(own.where(F.col("field") == f), f, F.col("content").alias("t")).select("id", cut(F.array_join(F.transform(f, lambda x: x["t"]), " "), MOST_TEXT).alias(f)) for f in OWN_FIELDS]
    others = first_n(chunks.where(~F.col("field").isin(*OWN_FIELDS)), ["id"], [F.col("order_no").asc_nulls_last(), "__node"], EXTRA_CHUNKS)
    named = lambda rows: rows.withColumn("name", _text("name")).where("name <> ''")
    lists = [
        _listed(first_wins(named(rel("requiresMaterial")), ["id", "name"], [F.col("order_no").asc_nulls_last(), "__node"]), "materials", F.col("name")),
        _listed(rel("hasProcessStep"), "steps", F.coalesce(F.col("order_no").cast("int").cast("string"), F.lit("")).alias("number"), _text("name").alias("name"), _text("time_limit").alias("time_limit")),
        _listed(cited(graph, rel("citesLegal")), "citations", F.col("__node").alias("citation_id"), "article", "content", "basis", "doc_no"),
        _listed(first_wins(named(rel("handledBy")), ["id", "name"], ["__node"]), "departments", F.col("name")),
        _listed(rel("hasChannel"), "channels", cut(_text("name"), MOST_CHANNEL).alias("name"), _text("channel_type").alias("kind"), _text("service_time").alias("service_time"), cut(_text("description"), MOST_NOTE).alias("description")),
        _listed(rel("hasFee"), "fees", _text("name").alias("name"), _text("fee_status").alias("status"), _text("fee_standard").alias("standard"), cut(_text("description"), MOST_NOTE).alias("basis")),
        _listed(rel("hasFaq"), "faqs", _text("name").alias("question"), cut(_text("answer"), MOST_TEXT).alias("answer")),
        _listed(others, "chunks", F.col("field").alias("source_field"), cut("content", MOST_TEXT).alias("content")),
    ]
    out = chosen.select("id", _text("name").alias("name"))
    out = reduce(lambda df, x: df.join(x, "id", "left"), [*lists, *texts], out)
    empty = {x.columns[1]: F.coalesce(x.columns[1], F.array().cast(x.schema[1].dataType)) for x in lists} | {f: F.coalesce(f, F.lit("")) for f in OWN_FIELDS}
    return out.withColumns(empty)


def retrieve_context(graph: Graph, question: str, embed: Callable[[str], Sequence[float]], k: dict[str, int] | None = None, citation_names: DataFrame | None = None, shared_ids: bool = True) -> dict[str, DataFrame]:
    """seeds, services, materials, citations. Nearest nodes of each type above a floor; the context of the two nearest services of different names; of the
    four nearest materials those that no chosen service lists; of the six nearest citations (by content, then by name in `citation_names`: id, name,
    vector) those of which no service and none before has the key; and bases from a higher floor on whose title is not covered yet, as citations without article."""
    k = k or {graph.model.primary: 5, "material": 5, "citation": 5, "basis": 3}
    target = embed(question)
    found = vector.search_all([(t, graph.vectors[t], "id", "vector", "name", n, FLOOR) for t, n in k.items() if t in graph.vectors], target)
    chosen = vector.best_by_name(found.where(F.col("label") == graph.model.primary), SERVICES).select("id", "name")
    services = service_context(graph, chosen)
    listed = services.select(F.explode("materials").alias("x")).select("x.name").distinct()
    nearest = found.where("label = 'material'").orderBy(F.desc("score"), "id").limit(MATERIALS)
    materials = nearest.join(_nodes(graph, "material").select("__node", _text("name").alias("own")), F.col("id") == F.col("__node")).join(listed.select(F.col("name").alias("own")), "own", "left_anti").select("id", F.col("own").alias("name"), "score")
    rank = found.where("label = 'citation'").select("id", "score", F.lit(0).alias("turn"))
    if citation_names is not None:
        named = vector.top_k(citation_names, target, max(2, k.get("citation", 5) // 2), "id", "vector").select("id", "score", F.lit(1).alias("turn"))
        rank = rank.unionByName(named)
    rank = rank.orderBy("turn", F.desc("score"), "id").limit(CITATIONS).withColumn("place", F.struct("turn", -F.col("score"), "id"))
    extra = cited(graph, rank.join(_nodes(graph, "citation"), F.col("id") == F.col("__node"))).withColumn("key", citation_key(shared_ids))
    theirs = services.select(F.explode("citations").alias("x")).select(F.col("x.citation_id").alias("__node"), "x.article", "x.basis").withColumn("key", citation_key(shared_ids))
    extra = first_wins(extra.join(theirs.select("key").distinct(), "key", "left_anti"), ["key"], ["place"])
    covered = extra.select("basis").unionByName(theirs.select("basis")).distinct()
    bases = found.where((F.col("label") == "basis") & (F.col("score") >= BASIS_FLOOR)).join(_nodes(graph, "basis").select("__node", _text("name").alias("basis"), "doc_no"), F.col("id") == F.col("__node"))
    bases = first_wins(bases.join(covered, "basis", "left_anti"), ["basis"], [F.desc("score"), "id"])
    citations = extra.select("id", _text("name").alias("name"), "article", "content", "basis", "doc_no").unionByName(bases.select("id", F.col("basis").alias("name"), F.lit("").alias("article"), F.lit("").alias("content"), "basis", _text("doc_no").alias("doc_no")))
    return {"seeds": found, "services": services, "materials": materials, "citations": citations}


def material_users(graph: Graph, materials: DataFrame, most: int = 8) -> DataFrame:
    """id and the names of services that require a material."""
    rel = next(r for r, (_, end) in graph.model.relations.items() if end == "material")
    pairs = traverse.hop(materials, graph.edges, rel, out=False).join(graph.nodes[graph.model.primary].select(F.col("id").alias("__id"), F.col("name").alias("__name")), F.col("dst") == F.col("__id"))
    return traverse.collected(pairs, "src", F.col("__name"), F.col("__name"), most, "services").withColumnRenamed("src", "id")
