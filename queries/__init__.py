"""Queries over the test tables, one per operator."""

from queries import cleaning, dedup, events, gold, layers, linkage, missing_keys, quality, scans, silver, summaries  # noqa: F401
from queries.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
