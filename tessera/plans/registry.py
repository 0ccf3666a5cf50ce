"""Registry of named queries (one per SURVEY §2 inventory line).

``register(name, op, sql=..., fixtures=...)`` records a callable
``(spark, sf_dir) -> DataFrame`` and, for operators a second engine can
compute, the DuckDB oracle text over the driver's views.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.util import unify_round
from tessera.sources.fixture_sql import with_fixtures

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    op: str
    fn: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}

CATALOG_MODULES = [
    "tessera.plans.catalog_sources",
    "tessera.plans.catalog_clean",
    "tessera.plans.catalog_impute",
    "tessera.plans.catalog_joins",
    "tessera.plans.catalog_neighbours",
    "tessera.plans.catalog_aggregate",
    "tessera.plans.catalog_group",
    "tessera.plans.catalog_topk",
    "tessera.plans.catalog_encode",
    "tessera.plans.catalog_folds",
    "tessera.plans.catalog_models",
    "tessera.plans.catalog_evaluate",
    "tessera.plans.catalog_blend",
    "tessera.plans.catalog_contracts",
    "tessera.plans.catalog_reports",
]


def register(name: str, op: str, sql: str | None = None, fixtures: tuple[str, ...] = ("w",)):
    def deco(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        full = None
        if sql is not None:
            full = unify_round(with_fixtures(sql, *fixtures) if fixtures else sql)
        REGISTRY[name] = Entry(name, op, fn, full)
        return fn

    return deco


def load_all() -> dict[str, Entry]:
    for m in CATALOG_MODULES:
        importlib.import_module(m)
    return REGISTRY
