"""Every registered query with its DuckDB counterpart."""

from jobstrata.catalog import (  # noqa: F401
    cleaning,
    demand,
    features,
    funnels,
    gaps,
    market,
    models,
    profiling,
)
from jobstrata.catalog.registry import REGISTRY

__all__ = ["REGISTRY"]
