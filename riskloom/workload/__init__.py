"""The operators as checkable queries over the driver's tables."""

from __future__ import annotations


def load_queries():
    """All registered queries by name."""
    from riskloom.workload import arrears, cleaning, drift, features, profiling, sources, training  # noqa: F401
    from riskloom.workload.registry import QUERIES

    return dict(QUERIES)
