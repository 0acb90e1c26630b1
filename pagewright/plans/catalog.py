"""Registry of driver queries: name -> (Spark plan builder, independent oracle SQL or None).

A plan builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables. The
oracle SQL is written independently (regex / relational SQL over the raw tables) and must
produce the same column names; a ``None`` oracle means the result is checked by tests against a
brute-force reference instead.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, tuple[Plan, str | None]] = {}

_MODULES = (
    "pagewright.plans.html_pages",
    "pagewright.plans.fetch_results",
    "pagewright.plans.pattern_plans",
    "pagewright.plans.content_plans",
    "pagewright.plans.record_plans",
    "pagewright.plans.graph_plans",
    "pagewright.plans.config_plans",
    "pagewright.plans.output_plans",
    "pagewright.plans.activity_plans",
    "pagewright.plans.stream_plans",
)


def register(name: str, sql: str | None = None):
    def deco(fn: Plan) -> Plan:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query name {name!r}")
        _REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load() -> None:
    for mod in _MODULES:
        importlib.import_module(mod)


def queries() -> dict[str, Plan]:
    _load()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}
