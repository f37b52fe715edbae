"""Registered queries with their SQL, named service queries, whole runs."""

from . import more, queries, service_queries  # noqa: F401  (each registers its own)
from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
