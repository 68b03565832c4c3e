"""Key checks of many tables from one aggregation.

Every table is read once and gives a row for each of its checked columns: which column it is, and the value. All
these rows are counted together per value, with a counter for each column, so there is one shuffle, to which
every task sends a row per value. Whether values repeat or are missing, which have no parent and how
many rows a table has is read off these counts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Measure = Callable[[], Column]
_WHOLE = ("tinyint", "smallint", "int", "bigint")


class KeyCounts:
    """Collects what is to be measured, then counts. Unknown tables and columns raise at once."""

    def __init__(self, tables: dict[str, DataFrame]) -> None:
        self.tables = tables
        self.sides: list[tuple[str, str | None]] = []
        self.domains: list[int] = []

    def _side(self, table: str, column: str | None) -> int:
        """The number of a column; columns that are compared with each other share a domain."""
        if (table, column) not in self.sides:
            self.tables[table].select(*[column] if column else [])
            self.sides.append((table, column))
            self.domains.append(len(self.domains))
        return self.sides.index((table, column))

    def _count(self, side: int) -> Column:
        """Rows of a column with the value at hand."""
        return F.when(F.col("domain") == self.domains[side], F.col(f"c{side}")).otherwise(0)

    def repeated(self, table: str, column: str) -> Measure:
        """Values that occur more than once."""
        side = self._side(table, column)
        return lambda: F.count_if(F.col("present") & (self._count(side) > 1))

    def missing(self, table: str, column: str) -> Measure:
        side = self._side(table, column)
        return lambda: _total(F.when(~F.col("present"), self._count(side)))

    def orphans(self, table: str, column: str, parent: str, parent_column: str) -> Measure:
        """Rows whose value the parent does not have."""
        child, known = self._side(table, column), self._side(parent, parent_column)
        kept, other = self.domains[known], self.domains[child]
        self.domains = [kept if domain == other else domain for domain in self.domains]
        alone = lambda: F.col("present") & (self._count(known) == 0)
        return lambda: _total(F.when(alone(), self._count(child)))

    def rows(self, table: str) -> Measure:
        counted = [side for side, (name, _) in enumerate(self.sides) if name == table]
        side = counted[0] if counted else self._side(table, None)
        return lambda: _total(self._count(side))

    def counts(self) -> DataFrame:
        """A row per value of each domain, with the number of its rows in each column."""
        parts = []
        for table in dict.fromkeys(name for name, _ in self.sides):
            kinds = dict(self.tables[table].dtypes)
            entries = []
            for side, (name, column) in enumerate(self.sides):
                if name == table:
                    value = F.lit(None) if column is None else F.col(f"`{column}`")
                    whole = column is not None and kinds[column] in _WHOLE
                    entries.append(F.struct(
                        F.lit(self.domains[side]).alias("domain"), F.lit(side).alias("side"),
                        (value if whole else F.lit(None)).cast("bigint").alias("number"),
                        (F.lit(None) if whole else value).cast("string").alias("text"),
                    ))
            columns = [c for name, c in self.sides if name == table and c]
            rows = self.tables[table].select(*dict.fromkeys(columns)) if columns else self.tables[table]
            parts.append(rows.select(F.explode(F.array(*entries)).alias("k")).select("k.*"))
        united = reduce(DataFrame.unionByName, parts)
        counters = [F.count_if(F.col("side") == side).alias(f"c{side}") for side in range(len(self.sides))]
        counted = united.groupBy("domain", "number", "text").agg(*counters)
        return counted.withColumn("present", F.col("number").isNotNull() | F.col("text").isNotNull())


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))
