"""All queries of the core by name, with the SQL each must agree with."""

from __future__ import annotations

from importlib import import_module

FLAGSHIP = "tk01_rank_fusion"
MODULES = ["keyed", "scalars", "relations", "analytics", "records", "legal", "pages", "graph", "stored", "statutes", "labels", "exports", "identity"]


def _modules():
    return [import_module(f"lexloom.plans.{m}") for m in MODULES]


def queries() -> dict:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in _modules() for k, v in m.SQL.items()}
