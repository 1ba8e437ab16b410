"""Operator and recipe queries over the driver's tables, each with SQL that states the result."""

from __future__ import annotations

from .registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query", "load_all"]


def load_all() -> dict[str, Query]:
    from . import (  # noqa: F401
        analyses,
        columns,
        contracts,
        documents,
        estimates,
        ledgers,
        relations,
        seriesq,
        statistics,
        tables,
    )

    return REGISTRY
