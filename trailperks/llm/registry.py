"""Queries of this folder and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(spark, folder)`` under ``name``."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
