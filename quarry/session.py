"""Session factory with the settings that the engine is designed for."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
_SHIPPED: set[str] = set()

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str = "local[8]", shuffle_partitions: int = 8, driver_memory: str = "8g", **more: str) -> SparkSession:
    """A session on `master`; `more` holds further Spark settings, with _ for each dot."""
    builder = SparkSession.builder.master(master).appName("quarry").config("spark.driver.memory", driver_memory)
    settings = SETTINGS | {"spark.sql.shuffle.partitions": str(shuffle_partitions)} | {k.replace("_", "."): v for k, v in more.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends this package to Python workers that would not find it: once for an application, and only if neither the working folder
    nor PYTHONPATH is the repository."""
    context = spark.sparkContext
    known = [Path.cwd(), *(Path(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p)]
    if context.applicationId in _SHIPPED or any(p.resolve() == ROOT for p in known):
        return
    path = Path(tempfile.mkdtemp(prefix="quarry-")) / "quarry.zip"
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted((ROOT / "quarry").rglob("*.py")):
            out.write(f, f.relative_to(ROOT))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)
