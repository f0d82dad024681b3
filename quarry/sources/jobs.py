"""Import jobs: a list of tables with column mappings, in the order of their dependencies, and what is left to do of each."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import table_digest
from ..functions.text import iso_seconds
from ..operators.adapt import map_columns
from ..operators.state import pending

#: Groups of jobs in the order they depend on each other.
GROUPS = ("concepts", "entities", "chunks", "relations")


@dataclass
class Job:
    """key, group, path and mapping of columns; a type for nodes, or (source, relation, target) for edges; ids of indexes that chunks need."""

    key: str
    group: str
    path: str
    mapping: dict[str, list[str]]
    type: str = ""
    relation: tuple[str, str, str] | None = None
    index_ids: list[int] = field(default_factory=list)


def read_jobs(text: str) -> list[Job]:
    """Jobs of a JSON manifest; a job is a node or an edge job, keys are unique, chunk jobs name their indexes."""
    jobs = [Job(**{**j, "mapping": {c: [t] if isinstance(t, str) else t for c, t in j["mapping"].items()}, "relation": tuple(j["relation"]) if j.get("relation") else None}) for j in json.loads(text)]
    keys = [j.key for j in jobs]
    problems = [f"repeated key {k}" for k in sorted({k for k in keys if keys.count(k) > 1})]
    problems += [f"{j.key}: unknown group {j.group}" for j in jobs if j.group not in GROUPS]
    problems += [f"{j.key}: needs a type or a relation" for j in jobs if bool(j.type) == bool(j.relation)]
    problems += [f"{j.key}: chunks need index ids" for j in jobs if j.group == "chunks" and not j.index_ids]
    if problems:
        raise ValueError("; ".join(problems))
    return in_order(jobs)


def in_order(jobs: Iterable[Job]) -> list[Job]:
    """By group, then as listed."""
    return sorted(jobs, key=lambda j: GROUPS.index(j.group))


def select(jobs: list[Job], keys: Iterable[str] | None = None) -> list[Job]:
    wanted = set(keys) if keys else None
    lost = (wanted or set()) - {j.key for j in jobs}
    if lost:
        raise KeyError(f"no such jobs: {', '.join(sorted(lost))}")
    return [j for j in jobs if wanted is None or j.key in wanted]


def payload(job: Job, table: DataFrame) -> DataFrame:
    """The table under its properties' names."""
    return map_columns(table, job.mapping)


def content_key(job: Job, table: DataFrame) -> DataFrame:
    """job, digest, rows: what a finished import is known by; it does not depend on the order of rows."""
    return table_digest(table).select(F.lit(job.key).alias("job"), F.col("digest").cast("string").alias("digest"), "rows")


def left_to_do(contents: DataFrame, finished: DataFrame) -> DataFrame:
    """Contents that no finished import has."""
    key = F.concat_ws(":", "job", "digest")
    return pending(contents.withColumn("content", key), finished.select(key.alias("content")), "content").drop("content")


def lanes(jobs: list[Job], done: set[str], width: int = 3) -> list[list[Job]]:
    """What is left to do, in stages of jobs that do not depend on each other, each dealt to `width` lanes in turn. A stage's jobs begin when the stages before are done."""
    out = []
    for group in GROUPS:
        left = [j for j in in_order(jobs) if j.group == group and j.key not in done]
        out += [left[k::width] for k in range(min(width, len(left)))] if left else []
    return out


def supervise(jobs: list[Job], run: Callable[[Job], bool], done: set[str], width: int = 3, sweeps: int = 2) -> tuple[set[str], list[str]]:
    """Runs what is left, stage by stage in lanes side by side; jobs that fail are swept up again, `sweeps` times at most. A stage that is not done ends the run. Gives what is done and what failed."""
    done = set(done)
    for group in GROUPS:
        for _ in range(sweeps + 1):
            left = [j for j in in_order(jobs) if j.group == group and j.key not in done]
            if not left:
                break
            with ThreadPoolExecutor(width) as pool:
                done |= {j.key for j, good in zip(left, pool.map(run, left)) if good}
        failed = [j.key for j in in_order(jobs) if j.group == group and j.key not in done]
        if failed:
            return done, failed
    return done, []


@dataclass
class Watchdog:
    """Says when a service is to be started anew: its longest transaction is over `most` seconds, `cooldown` seconds have passed since the last time, and there were less than `daily` times that day."""

    most: float = 600
    cooldown: float = 1800
    daily: int = 4
    times: list[float] = field(default_factory=list)

    def due(self, longest: float, now: float) -> bool:
        """longest: seconds, negative if they are not known."""
        today = [t for t in self.times if t // 86_400 == now // 86_400]
        if longest <= self.most or len(today) >= self.daily or (self.times and now - self.times[-1] < self.cooldown):
            return False
        self.times.append(now)
        return True


def longest_running(transactions: DataFrame, state: str = "Closing") -> DataFrame:
    """seconds: the longest of the transactions (status, elapsed as an ISO duration) in a state; 0 if there are none."""
    return transactions.where(F.col("status") == state).agg(F.coalesce(F.max(iso_seconds("elapsed")), F.lit(0.0)).alias("seconds"))
