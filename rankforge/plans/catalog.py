"""Import every query module so the registry is complete, and expose it."""

from __future__ import annotations

from rankforge.plans import q_core, q_features, q_functions, q_fusion, q_metrics, q_models, q_pipelines, q_prep, q_retrieval, q_sources, q_tuning  # noqa: F401
from rankforge.plans.registry import REGISTRY


def queries():
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
