"""Registry of named queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    run: Run
    sql: str | None
    operator: str


REGISTRY: dict[str, Query] = {}


def query(name: str, operator: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name``; ``operator`` is its number in the inventory."""

    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, run, sql, operator)
        return run

    return register
