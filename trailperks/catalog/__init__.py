"""Registered queries over the given tables, and their SQL counterparts."""

from trailperks.catalog import flows, models, profile, quality, reports  # noqa: F401
from trailperks.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
