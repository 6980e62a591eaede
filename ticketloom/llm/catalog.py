"""All queries of the corpus operators: name to run, and name to reference SQL."""

from __future__ import annotations

from importlib import import_module

from ticketloom.llm.registry import QUERIES, SQL, Run

MODULES = ["packing", "simhash", "quality", "decontaminate", "secrets", "sharding", "topk", "chat", "repeats", "passages", "frames", "infill", "prefix_trie"]


def load() -> tuple[dict[str, Run], dict[str, str]]:
    for name in MODULES:
        import_module(f"ticketloom.llm.{name}")
    return QUERIES, SQL
