"""Registered queries with their oracles, by operator family."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ["lookups", "aggregates", "windows", "sets", "columns", "scans", "functions",
            "quality", "loads", "measures", "business"]


def load_all():
    """All registered queries by name."""
    for family in FAMILIES:
        import_module(f"workload.{family}")
    from .registry import REGISTRY

    return REGISTRY
