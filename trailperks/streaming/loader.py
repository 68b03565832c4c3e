"""Loader: change stream into the activity table.

A micro-batch is parsed and written as it comes, without a shuffle, into its own folder of the change
journal; running a batch twice leaves the same rows. The checkpoint commits the offset after the
write. The current table is the last change per activity over the journal; ``compact`` folds the
batches written so far into a snapshot and records which they were. Batches are never told apart by
their order: a row of the snapshot keeps the place of its message in the stream, and a change replaces
it if its own place is later, whichever checkpoint, and whichever fold, brought it.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from trailperks import labels as L, schemas
from trailperks.operators.changes import accepted, latest_per_activity, parse, rejected
from trailperks.params import small_table
from trailperks.session import cut_lineage
from trailperks.sources.layers import Layers
from trailperks.streaming.batches import start_batches

ACTIVITIES = "raw.activites"
JOURNAL = "raw.activites_journal"
LOAD_LOG = "monitoring.chargements"
FOLDED = "raw.activites_lots"

CHANGE_SCHEMA = T.StructType([
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    *schemas.RAW_ACTIVITIES.fields,
])
JOURNAL_SCHEMA = T.StructType([
    *CHANGE_SCHEMA.fields, T.StructField("rejet", T.StringType()),
    T.StructField("batch", T.StringType()),
])
LOG_SCHEMA = T.StructType([*schemas.PIPELINE_RUNS.fields, T.StructField("batch", T.StringType())])
FOLDED_SCHEMA = T.StructType([
    T.StructField("batch", T.StringType()), T.StructField("version", T.LongType()),
])


def load_batch(layers: Layers, batch: DataFrame, name: str) -> None:
    """Write one micro-batch and log the number of changes it accepted, counted while writing."""
    start = datetime.now(timezone.utc)
    seen = Observation()
    rows = parse(batch).withColumn("charge_le", F.lit(start).cast("timestamp"))
    good = F.count_if(F.col("rejet").isNull())
    layers.write_batch(JOURNAL, rows.observe(seen, good.alias("n")), name)
    entry = (
        f"{L.LOADER_STEP}-{name}", L.LOADER_STEP, start, datetime.now(timezone.utc), L.RUN_OK,
        seen.get["n"], None,
    )
    layers.write_batch(LOAD_LOG, small_table(layers.spark, [entry], schemas.PIPELINE_RUNS), name)


def load_log(layers: Layers) -> DataFrame:
    return layers.read_batches(LOAD_LOG, LOG_SCHEMA)


def open_batches(layers: Layers) -> list[str]:
    """Complete batches that the published snapshot does not hold: those since the last fold."""
    folded = layers.read_log(FOLDED, FOLDED_SCHEMA).where(
        F.col("version") <= (layers.version(ACTIVITIES) or 0)
    )
    return sorted(row["batch"] for row in load_log(layers).join(folded, "batch", "left_anti").collect())


def journal(layers: Layers) -> DataFrame:
    """All messages of the kept batches, bad ones included."""
    return layers.read_batches(JOURNAL, JOURNAL_SCHEMA)


def rejected_messages(layers: Layers) -> DataFrame:
    """Bad messages: those of the kept batches, and those a fold has set aside."""
    columns = ("partition", "offset", "rejet")
    aside = layers.read_log(REJECTED, REJECTED_SCHEMA)
    return rejected(journal(layers)).unionByName(aside.select(*columns)).distinct()


REJECTED = "raw.activites_rejets"
REJECTED_SCHEMA = T.StructType([JOURNAL_SCHEMA[name] for name in ("partition", "offset", "rejet")])


def start_loader(
    layers: Layers, messages: DataFrame, checkpoint: str, interval: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Load the stream; without an interval, load what is there and stop."""
    return start_batches(
        messages, checkpoint, lambda batch, name: load_batch(layers, batch, name), interval, drain
    )


def current_activities(layers: Layers) -> DataFrame:
    """The activity table as of the last committed batch."""
    unchanged, newest = _parts(layers, open_batches(layers))
    rows = newest if unchanged is None else unchanged.unionByName(newest)
    return rows.select(*schemas.RAW_ACTIVITIES.fieldNames())


def _parts(layers: Layers, batches: list[str]) -> tuple[DataFrame | None, DataFrame]:
    """The snapshot rows that no batch touches (None before the first fold), and the others, renewed.

    Only the changes are reduced per key; the snapshot meets a list of changed ids, which is broadcast
    while it is short, and is not shuffled then.
    """
    columns = CHANGE_SCHEMA.fieldNames()
    changes = accepted(layers.read_batches(JOURNAL, JOURNAL_SCHEMA, batches)).select(*columns)
    newest = latest_per_activity(changes)
    if len({batch.rpartition("-")[0] for batch in batches}) > 1:
        # Two checkpoints may have read the same message.
        newest = newest.dropDuplicates(["id_activite"])
    if layers.version(ACTIVITIES) is None:
        return None, newest.select(*columns)
    newest = cut_lineage(newest)
    snapshot = layers.read(ACTIVITIES).select(*columns)
    ids = newest.select("id_activite")
    contested = snapshot.join(ids, "id_activite", "left_semi").select(*columns)
    renewed = latest_per_activity(contested.unionByName(newest.select(*columns)))
    unchanged = snapshot.join(ids, "id_activite", "left_anti").select(*columns)
    return unchanged, renewed.dropDuplicates(["id_activite"]).select(*columns)


def compact(layers: Layers, recluster: bool = False) -> None:
    """Fold the open batches into a new snapshot, which later reads take instead of them.

    Files of the snapshot hold narrow ranges of the start time. Rows that still hold are copied file
    by file, so only the changed rows are clustered; ``recluster`` does it for all rows, from time
    to time. The batches of earlier folds and old snapshots are deleted, bad messages kept aside.
    """
    batches, version = open_batches(layers), layers.version(ACTIVITIES)
    if not batches and not (recluster and version):
        return
    unchanged, newest = _parts(layers, batches)
    if unchanged is None or recluster:
        rows = newest if unchanged is None else unchanged.unionByName(newest)
        folder = layers.stage(ACTIVITIES, rows, cluster_by="date_debut")
    else:
        changed = newest.repartitionByRange(F.col("date_debut"))
        folder = layers.stage(ACTIVITIES, unchanged.unionByName(changed))
    folded = [(batch, (version or 0) + 1) for batch in batches]
    if folded:
        layers.append(FOLDED, small_table(layers.spark, folded, FOLDED_SCHEMA))
    layers.publish(ACTIVITIES, folder)
    _expire(layers, (version or 0))


def _expire(layers: Layers, version: int) -> None:
    """Delete the batches that were folded into the version before the newest, and older snapshots."""
    done = layers.read_log(FOLDED, FOLDED_SCHEMA).where(F.col("version") == version)
    names = sorted({row["batch"] for row in done.collect()})
    if names:
        bad = rejected(layers.read_batches(JOURNAL, JOURNAL_SCHEMA, names))
        layers.append(REJECTED, bad.select("partition", "offset", "rejet"))
    for name in names:
        layers.delete_batch(JOURNAL, name)
    layers.expire(ACTIVITIES)
