"""All queries of the core with their SQL."""

from __future__ import annotations

import importlib

MODULES = ("health", "drift", "curation", "dialogues", "predicates", "files", "sequences", "texts", "graphs", "manifests")


def _all(part: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out.update(getattr(importlib.import_module(f"millrace.plans.{name}").P, part))
    return out


def queries() -> dict:
    return _all("queries")


def oracle_sql() -> dict:
    return _all("sql")
