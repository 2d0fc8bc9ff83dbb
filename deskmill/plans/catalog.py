"""All registered queries and, next to each, the SQL it is checked against."""

from __future__ import annotations

import importlib

MODULES = ("shapes", "flat", "joined", "summaries", "ordered")


def _collect(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        part = getattr(importlib.import_module(f"deskmill.plans.{name}"), attribute)
        clash = merged.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        merged.update(part)
    return merged


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("ORACLES")
