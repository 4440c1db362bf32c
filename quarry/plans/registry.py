"""Query registry: one entry per SURVEY §2 operator bound to the driver tables.

Each entry pairs a Spark builder ``(spark, sf_dir) -> DataFrame`` with an
optional DuckDB oracle SQL text over the pre-registered table views.  Entries
without oracle are checked on rows only (iterative / stateful streaming).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class QuerySpec:
    name: str
    build: Builder
    oracle: str | None
    doc: str


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = QuerySpec(name, fn, oracle.strip() if oracle else None, (fn.__doc__ or "").strip())
        return fn

    return deco


def load_all() -> dict[str, QuerySpec]:
    """Import every plan module so that their ``@register`` calls run."""
    from quarry.plans import (  # noqa: F401
        aggregates,
        eventsourcing,
        functions_q,
        joins,
        lambda_q,
        loglake,
        monitoring,
        partitioning,
        predicates,
        quality,
        scans,
        search,
        setops,
        streaming_q,
        topk,
        windows,
    )

    return REGISTRY
