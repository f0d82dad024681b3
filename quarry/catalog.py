"""All queries of the library, with the SQL that checks them."""

from __future__ import annotations

from importlib import import_module

MODULES: tuple[str, ...] = ("cleaning", "graph", "search")


def queries() -> dict:
    return {name: f for m in MODULES for name, f in import_module(f"quarry.queries.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in import_module(f"quarry.queries.{m}").SQL.items()}
