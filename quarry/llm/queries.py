"""The queries of this package and their SQL."""

from __future__ import annotations

from . import bpe, exact_dedup, license_scan, mixing, near_dedup, neighbours, sharding, token_counts, token_files, toxicity

MODULES = (bpe, toxicity, token_files, neighbours, mixing, exact_dedup, near_dedup, token_counts, license_scan, sharding)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
