"""Table views over the driver data and the registered queries."""

from __future__ import annotations

from importlib import import_module

from countloom.plans.registry import Registry

GROUPS = ("bulk", "cell", "design", "integration", "meta", "metadata", "rule", "source", "stats")


def all_queries() -> Registry:
    """Every group's queries in one registry."""
    merged = Registry()
    for group in GROUPS:
        merged.merge(import_module(f"countloom.plans.{group}_queries").queries)
    return merged
