"""A registry of entity schemas, read from an indented schema text, and checks of import jobs against it."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

TYPES = {"Text": T.StringType(), "Integer": T.IntegerType(), "Double": T.DoubleType(), "Float": T.FloatType()}


@dataclass
class Entity:
    name: str
    label: str = ""
    kind: str = "EntityType"
    properties: dict[str, str] = field(default_factory=dict)
    relations: dict[str, str] = field(default_factory=dict)
    hints: dict[str, dict[str, str]] = field(default_factory=dict)

    def struct(self) -> T.StructType:
        """A schema with `id` first; hints such as the kind of index are field metadata."""
        fields = [T.StructField("id", T.StringType(), False)]
        for name, kind in self.properties.items():
            base = TYPES.get(kind, T.StringType())
            many = self.hints.get(name, {}).get("constraint") == "MultiValue"
            fields.append(T.StructField(name, T.ArrayType(base) if many else base, True, self.hints.get(name, {})))
        return T.StructType(fields)


_DECLARED = re.compile(r"^(\w+)\((.*?)\)\s*(?:->\s*[\w.]+\s*)?:\s*([\w.]+)\s*$")


def parse_schema(text: str) -> dict[str, Entity]:
    """Entities by name. A declaration is Name(label): Kind; below it stand `properties:` and `relations:` with declarations, and `index:` or `constraint:` lines below those."""
    entities: dict[str, Entity] = {}
    entity, section, last = None, "", ""
    for raw in text.splitlines():
        line = raw.split("#", 1)[0].strip()
        if not line or line.startswith("namespace"):
            continue
        found = _DECLARED.match(line)
        if line in ("properties:", "relations:"):
            section = line[:-1]
        elif found and not raw[0].isspace():
            entity, section = Entity(found[1], found[2], found[3]), ""
            entities[entity.name] = entity
        elif found and entity is not None:
            (entity.relations if section == "relations" else entity.properties)[found[1]] = found[3]
            last = found[1]
        elif entity is not None and re.match(r"(index|constraint|desc):", line):
            key, value = (x.strip() for x in line.split(":", 1))
            if last:
                entity.hints.setdefault(last, {})[key] = value
        else:
            raise ValueError(f"not understood: {raw!r}")
    return entities


def adapt_types(text: str) -> tuple[str, list[str]]:
    """The text with Double as Float, and the lines that changed."""
    lines, changed = [], []
    for line in text.splitlines():
        new = re.sub(r":\s*Double\b", ": Float", line)
        changed += [line.strip()] if new != line else []
        lines.append(new)
    return "\n".join(lines), changed


def resolve(entities: dict[str, Entity], target: str, namespace: str = "") -> Entity:
    """An entity by name, with or without its namespace."""
    name = target.removeprefix(f"{namespace}.") if namespace else target
    if name not in entities:
        raise KeyError(f"unknown type: {target}")
    return entities[name]


def job_problems(entities: dict[str, Entity], job: dict, columns: list[str]) -> list[str]:
    """What is wrong with an import job (type or relation, mapping of columns to properties) on a table with these columns."""
    problems = [f"missing column {c}" for c in job["mapping"] if c not in columns]
    targets = [t for ts in job["mapping"].values() for t in (ts if isinstance(ts, list) else [ts])]
    problems += [f"mapped more than once: {t}" for t in sorted({t for t in targets if targets.count(t) > 1})]
    if "relation" in job:
        source, relation, end = job["relation"]
        if entities.get(source, Entity("")).relations.get(relation) != end:
            problems.append(f"no relation {source}-{relation}-{end}")
        return problems
    if job["type"] not in entities:
        return [*problems, f"unknown type {job['type']}"]
    return problems + [f"unknown property {t}" for t in targets if t not in ("id", "name", "description") and t not in entities[job["type"]].properties]


def index_ids(value: str) -> list[int]:
    """A JSON list of positive whole numbers, each once, in order."""
    import json

    ids = json.loads(value)
    if not isinstance(ids, list) or any(isinstance(x, bool) or not isinstance(x, int) or x < 1 for x in ids):
        raise ValueError(f"not a list of positive numbers: {value}")
    return list(dict.fromkeys(ids))
