"""Multi-hop plans: a checked list of hops, compiled to DataFrames. Each name is bound to a frame, so that Catalyst sees all hops at once."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import traverse, vector
from .variants import Variant

MOST_HOPS, LOCATE_K, BOUND, TRAVERSE_LIMIT, QUERY_CHARS = 4, 5, 3, 30, 120


class PlanError(ValueError):
    """A plan that can't be run."""


@dataclass(frozen=True)
class Locate:
    step: int
    type: str
    query: str
    bind: str
    desc: str = ""


@dataclass(frozen=True)
class Traverse:
    step: int
    source: str
    relation: str
    direction: str
    bind: str
    desc: str = ""


def read_plan(reply: str) -> dict:
    """The JSON object in a reply, with or without fences."""
    body = re.search(r"\{.*\}", re.sub(r"```(?:json)?", "", reply or ""), re.DOTALL)
    if not body:
        raise PlanError("the reply holds no JSON object")
    try:
        return json.loads(body[0])
    except ValueError as e:
        raise PlanError(f"the plan is no JSON: {e}") from e


def check_plan(plan: dict, question: str, model: Variant) -> list[Locate | Traverse]:
    """Hops with names put right. The first locates; a traversal starts from a bound name; unknown actions are skipped; later hops than the fourth go."""
    raw = plan.get("hops") if isinstance(plan, dict) else None
    if not isinstance(raw, list) or not raw:
        raise PlanError("no hops")
    hops: list[Locate | Traverse] = []
    for step, h in enumerate(raw[:MOST_HOPS], 1):
        if not isinstance(h, dict):
            continue
        word = lambda k, default="": str(h.get(k) or default).strip()  # noqa: B023, E731
        action, bind = word("action").lower(), word("bind", f"n{step}")
        if step == 1 and action != "locate":
            raise PlanError("the first hop must locate")
        if action == "locate":
            kind = model.type_of(h.get("type"))
            if not kind:
                raise PlanError(f"this type can't be located: {h.get('type')}")
            hops.append(Locate(step, kind, word("query", question)[:QUERY_CHARS], bind, word("desc")))
        elif action == "traverse":
            relation = model.relation_of(h.get("relation"))
            if not relation:
                raise PlanError(f"unknown relation: {h.get('relation')}")
            if word("from") not in {x.bind for x in hops}:
                raise PlanError(f"this name is not bound: {word('from')}")
            direction = word("direction", "out").lower()
            hops.append(Traverse(step, word("from"), relation, direction if direction in ("out", "in") else "out", bind, word("desc")))
    if not hops or not isinstance(hops[0], Locate):
        raise PlanError("no hop to start from")
    return hops


@dataclass
class Graph:
    """nodes: frames (id, name) of each type. vectors: frames (id, name, vector) of types that can be located. edges: src, rel, dst."""

    model: Variant
    nodes: dict[str, DataFrame]
    vectors: dict[str, DataFrame]
    edges: DataFrame


@dataclass
class Run:
    """bound: type and frame (id, name) of each name. notes: why hops were skipped. fallback: why the plan was given up, if it was."""

    hops: list[Locate | Traverse] = field(default_factory=list)
    bound: dict[str, tuple[str, DataFrame]] = field(default_factory=dict)
    seeds: DataFrame | None = None
    notes: list[str] = field(default_factory=list)
    fallback: str = ""


def locate(graph: Graph, hop: Locate, embed: Callable[[str], Sequence[float]]) -> DataFrame:
    """Seeds (id, name, score) at or above the type's floor."""
    found = vector.top_k(graph.vectors[hop.type], embed(hop.query), LOCATE_K, "id", "vector", graph.model.types[hop.type])
    return found.select("id", "name", "score")


def compile_plan(graph: Graph, hops: list[Locate | Traverse], embed: Callable[[str], Sequence[float]]) -> Run:
    """Binds each hop's name to a frame. A hop from a name of another type is skipped with a note; nothing is computed yet."""
    run = Run(list(hops))
    for h in hops:
        if isinstance(h, Locate):
            seeds = locate(graph, h, embed)
            best = vector.best_by_name(seeds, 1 if h.type == graph.model.primary else BOUND).select("id", "name")
            labelled = seeds.select(F.lit(h.type).alias("label"), "id", "name", "score")
            run.seeds = labelled if run.seeds is None else run.seeds.unionByName(labelled)
            run.bound[h.bind] = (h.type, best)
            continue
        start, end = graph.model.relations[h.relation]
        start, end = (start, end) if h.direction == "out" else (end, start)
        kind, frame = run.bound[h.source]
        if kind != start:
            run.notes.append(f"hop {h.step} skipped: {h.source} is {kind}, {h.relation} starts from {start}")
            run.bound[h.bind] = (end, graph.nodes[end].limit(0).select("id", "name"))
            continue
        targets = traverse.hop(frame, graph.edges, h.relation, h.direction == "out").select(F.col("dst").alias("id")).distinct()
        named = graph.nodes[end].join(targets, "id", "left_semi").select("id", "name").orderBy("id").limit(TRAVERSE_LIMIT)
        run.bound[h.bind] = (end, named)
    return run


def run_plan(graph: Graph, reply: str, question: str, embed: Callable[[str], Sequence[float]]) -> Run:
    """A planner's reply, run. A broken plan and a first hop without hits are fallbacks; the caller then retrieves in one shot."""
    try:
        hops = check_plan(read_plan(reply), question, graph.model)
    except PlanError as e:
        return Run(fallback=str(e))
    run = compile_plan(graph, hops, embed)
    for h in hops:
        if isinstance(h, Locate) and run.bound[h.bind][1].isEmpty():
            run.fallback = "nothing was located"
            break
    return run


def services(run: Run, model: Variant, most: int = 2) -> DataFrame | None:
    """The services that were bound, later names first, each name once."""
    found = None
    for place, (kind, frame) in enumerate(reversed(run.bound.values())):
        if kind == model.primary:
            rows = frame.withColumn("place", F.lit(place))
            found = rows if found is None else found.unionByName(rows)
    if found is None:
        return None
    return found.groupBy("name").agg(F.min(F.struct("place", "id")).alias("k")).select(F.col("k.id").alias("id"), "name", F.col("k.place").alias("place")).orderBy("place", "id").limit(most)


def end_nodes(run: Run, model: Variant, most: int = 12) -> tuple[str, DataFrame] | None:
    """The nodes that the last hop reached, if they are no services."""
    for h in reversed(run.hops):
        if isinstance(h, Traverse):
            kind, frame = run.bound[h.bind]
            return None if kind == model.primary else (kind, frame.orderBy("id").limit(most))
    return None
