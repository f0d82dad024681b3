"""Question sets made of a graph: for each kind of question a template, an answer from a service's items, and bounds that both must meet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import numbered, required_label, squeeze, strip
from . import sample
from .dedup import first_n


@dataclass(frozen=True)
class Kind:
    """answer_type, relations that make it, question and answer heading ({name} and {anchor} stand for values), and how items are listed."""

    answer_type: str
    tables: str
    question: str
    heading: str
    listing: str = "names"
    hop: bool = False


# Kinds of questions with their texts, in the order of their numbers.
KINDS = {
    "material": Kind("materials", "requiresMaterial|Material", "{name}需要提交哪些申请材料？", "必要申请材料：\n", "required"),
    "department": Kind("department", "handledBy|Department", "{name}由哪个部门负责办理？", "办理部门：", "primary"),
    "legal": Kind("legal_basis", "citesLegal|LegalCitation|partOf|LegalBasis", "{name}办理依据哪些法规文件？", "主要法律依据：\n"),
    "condition": Kind("condition", "hasCondition|ServiceCondition", "办理{name}需要满足什么条件？", "办理条件：\n"),
    "process": Kind("process", "hasProcessStep|ProcessStep", "{name}的办理流程包含哪些环节？", "办理步骤：\n", "ordered"),
    "multi_hop_dept": Kind("multi_hop_dept", "handledBy|Department|GovernmentService", "除{name}外，{anchor}还负责办理哪些事项？", "{anchor}还负责办理以下事项：\n", hop=True),
    "multi_hop_material": Kind("multi_hop_material", "requiresMaterial|Material|GovernmentService", "除了{name}，还有哪些事项也需要提交{anchor}？", "还需要提交{anchor}的事项：\n", hop=True),
    "multi_hop_legal": Kind("multi_hop_legal", "citesLegal|LegalCitation|partOf|LegalBasis|GovernmentService", "还有哪些事项的办理依据是《{anchor}》？", "办理依据为《{anchor}》的事项：\n", hop=True),
    "faq": Kind("faq", "hasFaq|FAQ", "{name}的常见问答有哪些？", "常见问题：\n", "pairs"),
}
NAME_LENGTH, TARGETS, ANSWER_MOST, PAIRS = (6, 40), (3, 8), 800, 2
ITEM = "struct<name:string,order_no:string,required:string,role:string,answer:string>"


def _filled(template: str) -> Column:
    """A template with the values of the columns `name` and `anchor`."""
    parts, rest = [], template
    while rest:
        at = min((rest.find(k) for k in ("{name}", "{anchor}") if k in rest), default=-1)
        parts += [F.lit(rest if at < 0 else rest[:at])]
        if at < 0:
            break
        end = rest.index("}", at) + 1
        parts.append(F.col(rest[at + 1 : end - 1]))
        rest = rest[end:]
    return F.concat(*parts)


def _sorted(items: Column) -> Column:
    """Items by number, those without a number last, else in their order."""
    keyed = F.transform(items, lambda x, k: F.struct(x["order_no"].try_cast("int").isNull().alias("none"), x["order_no"].try_cast("int").alias("nr"), k.alias("k"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda s: s["x"])


def answer(kind: Kind) -> Column:
    """The expected answer from the column `items`; empty if there is nothing to list."""
    named = F.filter(F.coalesce("items", F.array().cast(f"array<{ITEM}>")), lambda x: x.isNotNull() & (strip(F.coalesce(x["name"], F.lit(""))) != ""))
    name = lambda x: strip(x["name"])
    distinct = F.array_distinct(F.transform(named, name))
    if kind.listing == "required":
        listed = numbered(F.transform(_sorted(named), lambda x: F.concat(name(x), required_label(x["required"]))))
    elif kind.listing == "ordered":
        listed = numbered(F.transform(_sorted(named), name))
    elif kind.listing == "primary":
        first = lambda yes: F.transform(F.filter(named, lambda x: F.contains(F.coalesce(x["role"], F.lit("")), F.lit("主管")) == F.lit(yes)), name)
        listed = F.array_join(F.array_distinct(F.concat(first(True), first(False))), "、")
    elif kind.listing == "pairs":
        pairs = F.slice(_sorted(F.filter(named, lambda x: strip(F.coalesce(x["answer"], F.lit(""))) != "")), 1, PAIRS)
        listed = F.array_join(F.transform(pairs, lambda x, k: F.concat((k + 1).cast("string"), F.lit(". 问："), name(x), F.lit("\n答："), squeeze(x["answer"]))), "\n")
    else:
        listed = numbered(distinct)
    return F.when(listed == "", "").otherwise(F.concat(_filled(kind.heading), listed))


def questions(candidates: DataFrame, kind_name: str) -> DataFrame:
    """Rows of the question set that meet all bounds. candidates: service_id, name, category_l1, category_l2, department_name, source_url, anchor, items."""
    kind = KINDS[kind_name]
    clean = {c: strip(F.coalesce(F.col(c), F.lit(""))) for c in ("service_id", "name", "category_l1", "category_l2", "department_name", "source_url", "anchor")}
    rows = candidates.withColumns(clean).where(F.length("name").between(*NAME_LENGTH) & (F.col("service_id") != ""))
    if kind.hop:
        targets = F.array_distinct(F.transform(F.filter("items", lambda x: strip(F.coalesce(x["name"], F.lit(""))) != ""), lambda x: strip(x["name"])))
        rows = rows.where((F.col("anchor") != "") & F.size(targets).between(*TARGETS))
    rows = rows.withColumn("expected_answer", answer(kind)).where((strip("expected_answer") != "") & (F.length("expected_answer") < ANSWER_MOST))
    department = F.when(F.col("department_name") != "", F.col("department_name")).otherwise(F.col("anchor") if kind_name == "multi_hop_dept" else F.lit(""))
    return rows.select(
        F.lit(kind_name).alias("kind"), _filled(kind.question).alias("question"), "expected_answer", F.concat(F.lit("service:"), "service_id").alias("doc_id"), F.col("name").alias("title"),
        "category_l1", "category_l2", "service_id", department.alias("department_name"), F.lit(kind.answer_type).alias("answer_type"), "source_url", F.lit(kind.tables).alias("source_tables"),
    )


def build(candidates: dict[str, DataFrame], per_kind: int, seed: int = 42, most_per_title: int = 2) -> DataFrame:
    """The question set: of each kind `per_kind` questions, taken from categories in turn, a title at most twice, with test_id in the kinds' order."""
    found = None
    for name in KINDS:
        if name in candidates:
            rows = questions(candidates[name], name)
            found = rows if found is None else found.unionByName(rows)
    order = F.coalesce(*(F.when(F.col("kind") == k, n) for n, k in enumerate(KINDS)))
    fair = first_n(found, ["title"], [sample.seeded(F.concat("kind", "doc_id"), seed), "kind"], most_per_title)
    chosen = sample.round_robin(fair, "kind", "category_l1", "doc_id", per_kind, seed)
    number = F.row_number().over(Window.orderBy("__o", "turn", "category_l1", "doc_id"))  # a question set is a few hundred rows
    return chosen.withColumn("__o", order).withColumn("test_id", F.format_string("MH%03d", number)).drop("__o", "turn", "kind")


def volumes(services: DataFrame, category: str = "category_l1") -> DataFrame:
    """Categories by their number of services, then by name."""
    return services.where(F.trim(F.coalesce(category, F.lit(""))) != "").groupBy(category).agg(F.count("*").alias("n")).orderBy(F.desc("n"), category)
