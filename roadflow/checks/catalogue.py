"""Importing this module registers every query."""

from roadflow.checks import network_queries, series_queries, stream_queries  # noqa: F401
from roadflow.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
