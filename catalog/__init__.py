"""Registered queries over the driver tables, with their check SQL."""

from catalog.registry import ORACLES, QUERIES
from catalog import (
    q_aggregates,
    q_composites,
    q_filters,
    q_joins,
    q_projections,
    q_scalars,
    q_sources,
    q_statistics,
    q_windows,
)


__all__ = ["ORACLES", "QUERIES"]
