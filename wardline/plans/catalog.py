"""Registry of named queries: a DataFrame builder plus its DuckDB oracle SQL.

A query reads the driver tables of one scale-factor folder (or data Spark
derives from them) and returns a DataFrame. The oracle SQL runs on the same
parquet tables; computed columns carry the same alias in both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    ops: tuple[str, ...]
    bench: bool = False
    #: layer of the result as a table of the warehouse; tables with a layer are published
    layer: str | None = None


_REGISTRY: dict[str, Query] = {}

PLAN_MODULES = ("quality_plans", "history", "dimensions", "marts", "indicators", "linkage_plans", "document_linkage", "given_truth", "selection", "sets_and_samples", "checks", "loading", "confrontation")


def query(name: str, sql: str | None = None, ops: tuple[str, ...] | list[str] = (), bench: bool = False, layer: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query name {name!r}")
        _REGISTRY[name] = Query(name, fn, sql, tuple(ops), bench, layer)
        return fn

    return deco


def registered(name: str) -> Query:
    """A query that is registered already."""
    return _REGISTRY[name]


def load_all() -> dict[str, Query]:
    """Import every plan module (registration happens at import) and return the registry."""
    import importlib

    modules = [importlib.import_module(f"wardline.plans.{m}") for m in PLAN_MODULES]
    for mod in modules:
        if hasattr(mod, "finalize"):
            mod.finalize(_REGISTRY)

    return dict(_REGISTRY)
