"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from hearthspark.plans.registry import QUERIES, Query

MODULES = ("feature_queries", "table_queries", "sampling_queries", "evaluation_queries", "neighbour_queries",
           "model_queries")


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"hearthspark.plans.{module}")
    return QUERIES
