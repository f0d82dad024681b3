"""Column functions, and a registry of those that SQL texts may call by name."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import text

#: Arrow functions that SQL texts get as temporary functions. What is a column expression has Spark's own functions in SQL.
REGISTRY = {"canonical": text.canonical, "canonical_json": text.canonical_json, "json_length": text.json_length}


def register_all(spark: SparkSession) -> list[str]:
    """Makes the registry's functions callable in SQL of this session."""
    for name, f in REGISTRY.items():
        spark.udf.register(name, f)
    return sorted(REGISTRY)
