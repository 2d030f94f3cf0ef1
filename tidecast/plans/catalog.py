"""All registered queries (imports populate the registry)."""

from __future__ import annotations

from . import q_clean, q_eval, q_features, q_forecast, q_history, q_models  # noqa: F401
from .registry import QUERIES


def queries():
    return {n: q.build for n, q in QUERIES.items()}


def oracle_sql():
    return {n: q.sql for n, q in QUERIES.items() if q.sql is not None}
