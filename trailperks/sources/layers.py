"""Stored tables by layer: full reloads that readers never see half-written, and appends."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from trailperks.params import small_table

VERSIONS = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("folder", T.StringType()),
])


@dataclass(frozen=True)
class Layers:
    """Tables below one root folder, addressed as ``layer.table``.

    A reload writes a new folder and then records it under the next number. Readers take the newest
    recorded one, so a failed write leaves the table as it was.
    """

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        layer, name = table.split(".")
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    # --- versioned tables ---------------------------------------------------------------------

    def _newest(self, table: str):
        recorded = self._read_folder(f"{self.path(table)}/versions", VERSIONS)
        return recorded.orderBy(F.desc("version"), F.desc("folder")).first()

    def version(self, table: str) -> int | None:
        """Newest complete version, or None before the first load."""
        newest = self._newest(table)
        return newest["version"] if newest else None

    def stage(
        self, table: str, rows: DataFrame, partition_by: tuple[str, ...] = (),
        cluster_by: str | None = None,
    ) -> str:
        """Write rows as a candidate for the next version and return its folder.

        Every call writes a folder of its own, so two writers never share one. Before a partitioned
        write the rows are rebalanced by the partition columns: each task then writes few folders, and
        adaptive execution splits a folder that would be too large for one task. ``cluster_by`` gives
        each file a narrow range of that column, so that a bound on it skips files.
        """
        if partition_by:
            rows = rows.hint("rebalance", *partition_by)
        if cluster_by:
            rows = rows.repartitionByRange(F.col(cluster_by))
        folder = f"v-{uuid.uuid4().hex}"
        rows.write.partitionBy(*partition_by).parquet(f"{self.path(table)}/{folder}")
        return folder

    def staged(self, table: str, folder: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path(table)}/{folder}")

    def publish(self, table: str, folder: str) -> int:
        """Make a staged folder the newest version."""
        version = (self.version(table) or 0) + 1
        recorded = small_table(self.spark, [(version, folder)], VERSIONS)
        recorded.write.mode("append").parquet(f"{self.path(table)}/versions")
        return version

    def reload(
        self, table: str, rows: DataFrame, partition_by: tuple[str, ...] = (),
        cluster_by: str | None = None,
    ) -> int:
        """Replace the whole table."""
        return self.publish(table, self.stage(table, rows, partition_by, cluster_by))

    def expire(self, table: str, keep: int = 2) -> None:
        """Delete the folders of all but the newest versions."""
        recorded = self._read_folder(f"{self.path(table)}/versions", VERSIONS)
        newest = self.version(table) or 0
        for row in recorded.where(F.col("version") <= newest - keep).collect():
            self.delete(f"{self.path(table)}/{row['folder']}")

    def delete(self, folder: str) -> None:
        """Delete a folder of this store; a missing one is no error."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def read(self, table: str) -> DataFrame:
        newest = self._newest(table)
        if newest is None:
            raise KeyError(table)
        return self.staged(table, newest["folder"])

    def read_or_empty(self, table: str, schema: T.StructType) -> DataFrame:
        """The table, or no rows before its first load."""
        if self.version(table) is None:
            return self.spark.createDataFrame([], schema)
        return self.read(table)

    # --- logs ---------------------------------------------------------------------------------

    def append(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path(table)}/log")

    def replace_log(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path(table)}/log")

    def read_log(self, table: str, schema: T.StructType) -> DataFrame:
        return self._read_folder(f"{self.path(table)}/log", schema)

    # --- batch folders ------------------------------------------------------------------------

    def _batch(self, table: str, batch: str) -> str:
        return f"{self.path(table)}/batches/batch={batch}"

    def write_batch(self, table: str, rows: DataFrame, batch: str) -> None:
        """Write the folder of one micro-batch; writing it again replaces it."""
        rows.write.mode("overwrite").parquet(self._batch(table, batch))

    def read_batches(
        self, table: str, schema: T.StructType, batches: list[str] | None = None
    ) -> DataFrame:
        """The given batch folders, or all of them, with the name of the folder as ``batch``."""
        root = f"{self.path(table)}/batches"
        if batches is None:
            return self._read_folder(root, schema)
        if not batches:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", root)
        return reader.parquet(*[self._batch(table, batch) for batch in batches])

    def delete_batch(self, table: str, batch: str) -> None:
        self.delete(self._batch(table, batch))

    def _read_folder(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise
