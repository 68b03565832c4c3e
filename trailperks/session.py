"""Session settings the rules rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Instants are shown in UTC; the Paris calendar date is an explicit conversion.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Where every partition of the smaller side is measured below this size, hash it instead of
    # sorting the larger side.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


# Size of a shuffle partition that one task sorts or aggregates without spilling much.
SHUFFLE_PARTITION_BYTES = 256 * 1024**2


def configure(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to an existing session.

    ``shuffle_bytes`` is the size of the largest shuffle to expect, about that of the activity table.
    It sets the number of shuffle partitions; adaptive execution merges those that stay small, but it
    cannot divide a partition of an aggregation that was planned too large.
    """
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if shuffle_bytes is not None:
        current = int(spark.conf.get("spark.sql.shuffle.partitions"))
        needed = -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES)
        spark.conf.set("spark.sql.shuffle.partitions", str(max(current, needed)))
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("trailperks")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        # Plans are built from many small expressions; recording a call site for each is slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="trailperks-")
    return _local_folders[application]


def new_run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Compute once and continue from the shared folder; survives the loss of executors."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """Compute once into a table of the shared folder and read that: as ``cut_lineage``, without computing twice."""
    folder = new_run_folder(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
