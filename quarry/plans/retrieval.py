"""Retrieval in one shot, context of services, and the ask that tries a plan first."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cut
from ..operators import traverse, vector
from ..operators.dedup import first_n
from .hops import Graph, Run, run_plan, services

#: Names that are listed for each relation of a service.
LIMITS = {"material": 20, "step": 30, "citation": 10, "result": 10}
FLOOR, BASIS_FLOOR = 0.45, 0.8


def expand(graph: Graph, chosen: DataFrame, limits: dict[str, int] = LIMITS, separator: str = "、") -> DataFrame:
    """id, name and a column for each relation that leaves the service type: the first names, joined."""
    out = chosen.select("id", "name")
    for rel, (start, end) in graph.model.relations.items():
        if start != graph.model.primary or end not in graph.nodes:
            continue
        pairs = traverse.hop(chosen, graph.edges, rel).join(graph.nodes[end].select(F.col("id").alias("__id"), F.col("name").alias("__name")), F.col("dst") == F.col("__id"))
        names = traverse.collected(pairs, "src", F.col("__name"), F.col("dst"), limits.get(end, 10), rel, separator)
        out = out.join(names, F.col("id") == F.col("src"), "left").drop("src").withColumn(rel, F.coalesce(rel, F.lit("")))
    return out


def used_by(graph: Graph, rel: str, targets: DataFrame, most: int = 8) -> DataFrame:
    """id and the names of services that lead to a node."""
    pairs = traverse.hop(targets, graph.edges, rel, out=False).join(graph.nodes[graph.model.primary].select(F.col("id").alias("__id"), F.col("name").alias("__name")), F.col("dst") == F.col("__id"))
    return traverse.collected(pairs, "src", F.col("__name"), F.col("__name"), most, "services").withColumnRenamed("src", "id")


def retrieve(graph: Graph, question: str, embed: Callable[[str], Sequence[float]], k: dict[str, int] | None = None, services_most: int = 2) -> dict[str, DataFrame]:
    """seeds; services with their context; extra: located nodes of other types that no chosen service covers, bases at a higher floor."""
    k = k or {"material": 5, "citation": 5, "basis": 3, graph.model.primary: 5}
    target = embed(question)
    found = [(t, graph.vectors[t], "id", "vector", "name", n, FLOOR) for t, n in k.items() if t in graph.vectors]
    seeds = vector.search_all(found, target)
    chosen = vector.best_by_name(seeds.where(F.col("label") == graph.model.primary), services_most).select("id", "name")
    covered = graph.edges.join(chosen.select(F.col("id").alias("src")), "src", "left_semi").select(F.col("dst").alias("id"))
    extra = seeds.where((F.col("label") != graph.model.primary) & ((F.col("label") != "basis") | (F.col("score") >= BASIS_FLOOR))).join(covered.distinct(), "id", "left_anti")
    return {"seeds": seeds, "services": expand(graph, chosen), "extra": extra.select("label", "id", "name", "score")}


def render(context: DataFrame, labels: dict[str, str], most_chars: int = 600) -> DataFrame:
    """id and one text: the name, then a line for each column that is filled, in the order of `labels`."""
    lines = [F.when(F.col(c) != "", F.concat(F.lit(f"{label}："), cut(c, most_chars))) for c, label in labels.items()]
    return context.select("id", F.concat_ws("\n", F.concat(F.lit("【"), "name", F.lit("】")), *lines).alias("context"))


def history(turns: DataFrame, most: int = 8, most_chars: int = 300) -> DataFrame:
    """conv_id and its last turns in order, each cut, a line each."""
    last = first_n(turns, ["conv_id"], [F.desc("turn")], most)
    line = F.concat("role", F.lit(": "), cut("text", most_chars))
    return last.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))), lambda x: x["l"]), "\n").alias("history"))


def ask(graph: Graph, question: str, embed: Callable[[str], Sequence[float]], planner: Callable[[str], str] | None = None) -> tuple[Run | None, dict[str, DataFrame]]:
    """A plan's run and its services with context; one shot where there is no planner, or its plan fell back."""
    if planner:
        try:
            reply = planner(question)
        except Exception as e:  # noqa: BLE001  a planner that fails is a plan that falls back
            run = Run(fallback=f"the planner failed: {e}")
        else:
            run = run_plan(graph, reply, question, embed)
        if not run.fallback:
            chosen = services(run, graph.model)
            if chosen is not None:
                return run, {"seeds": run.seeds, "services": expand(graph, chosen)}
            run.fallback = "no service was bound"
        return run, retrieve(graph, question, embed)
    return None, retrieve(graph, question, embed)
