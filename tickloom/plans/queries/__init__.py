"""The checked queries: one per operator, each with its SQL where SQL can state it."""

from tickloom.plans.queries import (  # noqa: F401
    aggregates,
    joins,
    ranges,
    rejects,
    scalars,
    sources,
    streams,
    windows,
)
from tickloom.plans.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
