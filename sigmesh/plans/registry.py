"""Registry of named queries: a Spark builder plus, where one exists, the
equivalent DuckDB SQL used as the correctness oracle."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class QuerySpec:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: Optional[str]
    ops: tuple


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, sql: Optional[str] = None, ops: tuple = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = QuerySpec(name, fn, sql, ops)
        return fn
    return deco


MODULES = ("q_cadence", "q_signals", "q_similarity", "q_verdict", "q_text", "q_evaluate", "q_graph", "q_feeds", "q_models", "q_pages", "q_lookup", "q_legacy", "q_graphnet", "q_iterative", "q_monitor", "q_extra", "q_archive", "q_cycles", "q_search", "q_store", "q_crawl", "q_varied", "q_review")


def load_all() -> dict[str, QuerySpec]:
    """Import every query module (importing fills the registry)."""
    import importlib
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")
    return REGISTRY
