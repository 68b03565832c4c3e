"""Readers of the change stream. Every reader yields ``partition, offset, value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trailperks import schemas
from trailperks.streaming.message_log import NAME, MessageLog


def from_kafka(
    spark: SparkSession, servers: str, topic: str, from_start: bool,
    messages_per_batch: int | None = None,
) -> DataFrame:
    """The topic from its first message or from now on. Needs the Kafka package on the cluster."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest" if from_start else "latest")
    )
    if messages_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", messages_per_batch)
    return reader.load().select("partition", "offset", F.col("value").cast("string").alias("value"))


def from_files(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON lines ``{partition, offset, value}``, for replays and tests."""
    reader = spark.readStream.schema(schemas.CHANGE_MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def from_log(
    spark: SparkSession, folder: str, checkpoint: str, from_start: bool = True,
    messages_per_batch: int | None = None,
) -> DataFrame:
    """A log of JSON-lines segments from its first message or from now on.

    The place at which a new checkpoint starts is kept beside it. The query must run at an interval or be drained:
    ``availableNow`` fixes the last position before the first batch, so with a limit it would read one batch only.
    """
    spark.dataSource.register(MessageLog)
    reader = (
        spark.readStream.format(NAME)
        .option("path", folder)
        .option("start", "earliest" if from_start else "latest")
        .option("startFile", f"{checkpoint.rstrip('/')}.start.json")
    )
    if messages_per_batch:
        reader = reader.option("messagesPerBatch", messages_per_batch)
    return reader.load()
