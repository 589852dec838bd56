"""Queries of the training-data operators by name, with the SQL each must agree with where SQL can say it."""

from __future__ import annotations

import warnings
from importlib import import_module

MODULES = ["splitting", "groups", "tokens", "mixing", "lines", "unify", "residue", "scans", "names"]


def _modules():
    """The modules that can be imported: one whose third-party dependency is missing is left out with a warning, alone."""
    found = []
    for m in MODULES:
        try:
            found.append(import_module(f"lexloom.llm.{m}"))
        except ImportError as e:
            if (e.name or "").startswith("lexloom"):
                raise
            warnings.warn(f"lexloom.llm.{m} is left out: {e}", stacklevel=2)
    return found


def queries() -> dict:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in _modules() for k, v in m.SQL.items()}
