"""Registration of queries: a Spark plan over the given tables and, where one exists, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from trailperks.session import configure
from trailperks.sources.testdata import TestTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def present(frame: DataFrame) -> DataFrame:
    """Types that both engines print alike: decimals as doubles, dates and instants as text."""
    columns = []
    for field in frame.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string").alias(field.name)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        columns.append(column)
    return frame.select(*columns)


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name``, with the SQL that must give the same rows."""

    def register(build: Callable[[TestTables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return present(build(TestTables(spark, sf_dir)))

        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
