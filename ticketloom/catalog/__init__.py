"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

MODULES = ["sources", "rows", "relational", "vectors", "monitoring"]


def load() -> dict:
    for name in MODULES:
        import_module(f"ticketloom.catalog.{name}")
    from ticketloom.catalog.registry import REGISTRY

    return REGISTRY
