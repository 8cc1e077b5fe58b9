"""Registered queries, one module per operator family."""

from __future__ import annotations

import importlib

from staffflow.plans.registry import REGISTRY, Query

FAMILIES = [
    "cleaning", "filtering", "indicators", "joining", "distributions", "histories", "reshaping",
    "rules", "preparation", "evaluation", "ranking", "segments", "files", "learning", "live",
]


def load_all() -> dict[str, Query]:
    for family in FAMILIES:
        importlib.import_module(f"staffflow.plans.{family}")
    return REGISTRY
