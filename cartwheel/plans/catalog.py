"""All registered queries (importing the modules registers them)."""

from __future__ import annotations

import importlib

from cartwheel.plans.registry import REGISTRY, oracle_text, spark_query

QUERY_MODULES = [
    "cartwheel.plans.pipeline_queries",
    "cartwheel.plans.eda_queries",
    "cartwheel.plans.dashboard_queries",
    "cartwheel.plans.policy_queries",
    "cartwheel.plans.survival_queries",
    "cartwheel.plans.clv_queries",
    "cartwheel.plans.model_queries",
    "cartwheel.plans.io_queries",
    "cartwheel.plans.given_queries",
]


def load_all() -> None:
    for m in QUERY_MODULES:
        importlib.import_module(m)


def queries():
    load_all()
    return {name: spark_query(e) for name, e in REGISTRY.items()}


def oracle_sql():
    load_all()
    return {name: oracle_text(e) for name, e in REGISTRY.items() if e.sql}
