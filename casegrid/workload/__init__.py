"""Registered queries: each operator bound to the given tables, with its SQL check."""

from . import bindings, clusters, ingest, joins, models, reports, scalars, summaries
from .registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "bindings", "clusters", "ingest", "joins", "models", "reports", "scalars",
    "summaries",
]
