"""Named queries over the given tables, each with its DuckDB oracle SQL where SQL can express it.

Every query reads the given Parquet tables (through the derived service tables in
``nearfield.sources.fixtures``) and runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    fn: QueryFn
    oracle: str | None


REGISTRY: dict[str, Entry] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(fn, oracle)
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules fills the registry.
    from nearfield.plans import q_search, q_geo, q_business, q_sync, q_telemetry, q_stream  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: v.fn for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v.oracle for k, v in REGISTRY.items() if v.oracle is not None}
