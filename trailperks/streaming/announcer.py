"""Announcer: new activities of the change stream as texts in an outbox table.

Runs beside the loader with its own checkpoint. Texts are written before the offset is committed, so a
failure may produce a batch twice, into the same folder. Messages are read, parsed and counted once per
batch: the announced activities are written first, small as they are, and read back to look up names.

With ``once``, an activity is announced once, however often its message comes, and not if its change
was captured longer than that before the newest change of earlier batches. The state of the stream are the
ids of two such spans: each leaves when the newest change is two spans ahead of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from trailperks import schemas
from trailperks.operators.changes import accepted, announceable, announced_texts, parse
from trailperks.params import small_table
from trailperks.sources.layers import Layers
from trailperks.sources.reference_files import ID_RANGE, NAMES, SALARIES, names_directory
from trailperks.streaming.batches import Counts, batch_counts, start_batches

OUTBOX = "notifications.messages"
NEW = "notifications.annonces"

OUTBOX_SCHEMA = T.StructType([
    T.StructField("id_activite", T.LongType()),
    T.StructField("texte", T.StringType()),
    T.StructField("batch", T.StringType()),
])
NEW_COLUMNS = (
    "id_activite", "id_salarie", "date_debut", "date_fin", "type_activite", "distance_m", "commentaire",
)
NEW_SCHEMA = T.StructType([schemas.RAW_ACTIVITIES[name] for name in NEW_COLUMNS])
# Messages of each batch: read, and announced.
COUNTS = "monitoring.annonces"
COUNTS_SCHEMA = T.StructType([
    T.StructField("lus", T.LongType()), T.StructField("publies", T.LongType()),
])
READ, TOLD = "lus", "publies"


def new_activities(
    messages: DataFrame, speed_limits: DataFrame, once: str | None = None
) -> DataFrame:
    """The activities of a stream to announce, with the observed numbers of messages and of these."""
    counted = messages.observe(READ, F.count(F.lit(1)).alias("n"))
    new = announceable(accepted(parse(counted)), speed_limits)
    if once:
        seen = F.coalesce("capture_le", "cree_le", "date_debut")
        new = new.withColumn("vu_le", seen).withWatermark("vu_le", once)
        new = new.dropDuplicatesWithinWatermark(["id_activite"])
    return new.select(*NEW_COLUMNS).observe(TOLD, F.count(F.lit(1)).alias("n"))


def names_of(layers: Layers, activities: DataFrame) -> DataFrame:
    """The names that the activities need.

    They are stored in folders by ranges of ids; only the folders that hold one of the ids are read.
    They are looked up in the newest version for every batch, so new employees are known at once;
    before the first ingestion there are none and the fallback name is used.
    """
    if layers.version(NAMES) is None:
        return names_directory(layers.read_or_empty(SALARIES, schemas.RAW_SALARIES))
    ranges = activities.select(F.floor(F.col("id_salarie") / ID_RANGE).cast("int").alias("r"))
    wanted = [row["r"] for row in ranges.where("r IS NOT NULL").distinct().collect()]
    return layers.read(NAMES).where(F.col("tranche").isin(wanted)).drop("tranche")


def announce_batch(layers: Layers, new: DataFrame, name: str) -> None:
    """Write the texts of the activities that one micro-batch announces."""
    layers.write_batch(NEW, new, name)
    written = layers.read_batches(NEW, NEW_SCHEMA, [name])
    layers.write_batch(OUTBOX, announced_texts(written, names_of(layers, written)), name)


def store_counts(layers: Layers, name: str, counts: Counts) -> None:
    row = tuple(counts[part]["n"] if part in counts else 0 for part in (READ, TOLD))
    layers.write_batch(COUNTS, small_table(layers.spark, [row], COUNTS_SCHEMA), name)


def start_announcer(
    layers: Layers, messages: DataFrame, checkpoint: str, speed_limits: DataFrame,
    interval: str | None = None, once: str | None = None, drain: bool = False,
) -> StreamingQuery:
    """Announce the stream; without an interval, announce what is there and stop.

    With ``once`` what is there is drained: Spark judges lateness by the watermark of the batch before, and only a
    drained query ends with the batch without messages that moves it on.
    """
    return start_batches(
        new_activities(messages, speed_limits, once), checkpoint,
        lambda batch, name: announce_batch(layers, batch, name), interval, drain or bool(once),
        lambda name, counts: store_counts(layers, name, counts),
    )


def outbox(layers: Layers) -> DataFrame:
    return layers.read_batches(OUTBOX, OUTBOX_SCHEMA)


def settle(spark: SparkSession) -> None:
    """Wait until the counts of the announcers that have ended are stored."""
    batch_counts(spark).settle()


def counters(layers: Layers) -> DataFrame:
    """Announced and ignored messages of every batch ever run."""
    settle(layers.spark)
    schema = T.StructType([*COUNTS_SCHEMA.fields, T.StructField("batch", T.StringType())])
    return layers.read_batches(COUNTS, schema).select(
        "batch", "publies", (F.col("lus") - F.col("publies")).alias("ignores")
    )


def preview(messages: DataFrame, speed_limits: DataFrame, names: DataFrame) -> DataFrame:
    """The texts a batch of messages would produce, without writing anything."""
    return announced_texts(announceable(accepted(parse(messages)), speed_limits), names)
