"""The graph models that plans are checked against: types with floors, relations with ends, and the names that stand for them."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Variant:
    """primary: the type of services. types: floor of each type that can be located, None for the others. relations: ends of each relation. type_names, relation_names: further names, in lower case."""

    name: str
    primary: str
    types: dict[str, float | None]
    relations: dict[str, tuple[str, str]]
    type_names: dict[str, str] = field(default_factory=dict)
    relation_names: dict[str, str] = field(default_factory=dict)

    def type_of(self, name: object) -> str | None:
        key = str(name or "").strip().lower()
        found = key if key in self.types else self.type_names.get(key)
        return found if found and self.types.get(found) is not None else None

    def relation_of(self, name: object) -> str | None:
        key = str(name or "").strip().lower()
        return next((r for r in self.relations if r.lower() == key), None) or self.relation_names.get(key)


# The two models' types with the least score to locate one, relations with their ends, and names in use.
FLOOR, BASIS_FLOOR = 0.45, 0.72
FLAT = Variant(
    "flat", "affair",
    {"affair": FLOOR, "material": FLOOR, "citation": FLOOR, "basis": BASIS_FLOOR, "step": None, "result": None, "cross": None, "org": None},
    {"requireMaterial": ("affair", "material"), "hasStep": ("affair", "step"), "nextStep": ("step", "step"), "citeLegal": ("affair", "citation"), "partOf": ("citation", "basis"), "produceResult": ("affair", "result"), "supportCrossRegion": ("affair", "cross"), "implementedBy": ("affair", "org")},
    {"事项": "affair", "政务事项": "affair", "材料": "material", "法条": "citation", "条款": "citation", "法规": "basis", "法律依据": "basis"},
    {"所需材料": "requireMaterial", "需要材料": "requireMaterial", "申请材料": "requireMaterial", "引用法条": "citeLegal", "所属法规": "partOf", "办理环节": "hasStep", "下一环节": "nextStep", "办理结果": "produceResult", "通办范围": "supportCrossRegion", "实施部门": "implementedBy", "实施主体": "implementedBy"},
)
LAYERED = Variant(
    "layered", "service",
    {"service": FLOOR, "material": FLOOR, "citation": FLOOR, "basis": BASIS_FLOOR, "chunk": FLOOR, "condition": FLOOR, "faq": FLOOR, "proposition": FLOOR, "step": None, "result": None, "department": None, "channel": None, "fee": None, "category": None, "domain": None},
    {"requiresMaterial": ("service", "material"), "hasProcessStep": ("service", "step"), "nextStep": ("step", "step"), "citesLegal": ("service", "citation"), "partOf": ("citation", "basis"), "producesResult": ("service", "result"), "handledBy": ("service", "department"), "collaboratesWith": ("service", "department"), "hasCondition": ("service", "condition"), "hasChunk": ("service", "chunk"), "hasFaq": ("service", "faq"), "hasChannel": ("service", "channel"), "hasFee": ("service", "fee"), "classifiedAs": ("service", "category"), "belongsToDomain": ("service", "domain"), "statesProposition": ("service", "proposition")},
    {"事项": "service", "政务事项": "service", "affair": "service", "材料": "material", "法条": "citation", "条款": "citation", "法规": "basis", "法律依据": "basis", "原文块": "chunk", "原文": "chunk", "办理条件": "condition", "条件": "condition", "常见问答": "faq", "问答": "faq", "命题": "proposition", "事实命题": "proposition"},
    {"所需材料": "requiresMaterial", "需要材料": "requiresMaterial", "申请材料": "requiresMaterial", "requirematerial": "requiresMaterial", "citelegal": "citesLegal", "引用法条": "citesLegal", "所属法规": "partOf", "办理步骤": "hasProcessStep", "办理环节": "hasProcessStep", "hasstep": "hasProcessStep", "下一步骤": "nextStep", "下一环节": "nextStep", "produceresult": "producesResult", "办理结果": "producesResult", "主管部门": "handledBy", "实施部门": "handledBy", "实施主体": "handledBy", "implementedby": "handledBy", "协同部门": "collaboratesWith", "办理条件": "hasCondition", "原文块": "hasChunk", "常见问答": "hasFaq", "办理渠道": "hasChannel", "收费信息": "hasFee", "所属分类": "classifiedAs", "所属领域": "belongsToDomain", "事实命题": "statesProposition"},
)
VARIANTS = {v.name: v for v in (FLAT, LAYERED)}


def variant(name: str) -> Variant:
    if name not in VARIANTS:
        raise ValueError(f"unknown graph model: {name}")
    return VARIANTS[name]
