"""Registered queries and job compositions."""

from __future__ import annotations

import importlib

from tidemark.plans.registry import REGISTRY, Query

MODULES = ("time_queries", "clean_queries", "feature_queries", "eda_queries", "forecast_queries", "stat_queries", "source_queries", "stream_queries", "model_queries", "job_queries")


def all_queries() -> dict[str, Query]:
    for name in MODULES:
        importlib.import_module(f"tidemark.plans.{name}")
    return dict(REGISTRY)
