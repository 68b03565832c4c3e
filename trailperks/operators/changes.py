"""Change events: parsing, latest state per key, announcements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from trailperks import labels as L, schemas
from trailperks.functions import messages, rules
from trailperks.session import written

POSITION = ("partition", "offset")
_CORRUPT = "_corrupt_record"
_ID = T.StructType([schemas.CHANGE_EVENT["id_activite"]])
_EVENT = T.StructType([*schemas.CHANGE_EVENT.fields, T.StructField(_CORRUPT, T.StringType())])


def _instant(text: Column) -> Column:
    """ISO-8601 text as an instant; NULL when it is none."""
    return F.try_to_timestamp(F.nullif(text, F.lit("")))


def parse(change_messages: DataFrame) -> DataFrame:
    """Messages (``partition, offset, value``) as activity rows, with ``rejet`` set on bad ones.

    Empty messages mark deletions in the source and are dropped: deletions do not propagate.
    A message is bad when it is not JSON of the expected types, has no id, or an unreadable date.
    """
    event = F.from_json("value", _EVENT, {"columnNameOfCorruptRecord": _CORRUPT})
    # As generated columns the fields stay put: a later filter on them is not pushed below the
    # parser, which would run it again for the filter.
    read = change_messages.where(F.col("value").isNotNull()).select(
        *POSITION, "value", F.inline(F.array(event))
    )
    dates = {name: _instant(F.col(name)) for name in ("date_debut", "date_fin", "cree_le")}
    bad = F.col(_CORRUPT).isNotNull() | F.col("id_activite").isNull()
    for name, instant in dates.items():
        bad = bad | (F.nullif(F.col(name), F.lit("")).isNotNull() & instant.isNull())
    captured = F.timestamp_millis(F.nullif(F.col("__source_ts_ms"), F.lit(0).cast("long")))
    return read.select(
        *POSITION,
        "id_activite",
        "id_salarie",
        dates["date_debut"].alias("date_debut"),
        "type_activite",
        "distance_m",
        dates["date_fin"].alias("date_fin"),
        "commentaire",
        "source",
        dates["cree_le"].alias("cree_le"),
        F.col("__op").alias("operation"),
        captured.alias("capture_le"),
        F.when(bad, F.col("value")).alias("rejet"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("rejet").isNull()).drop("rejet")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("rejet").isNotNull()).select(*POSITION, "rejet")


def place() -> Column:
    """The place of a message in the stream as one number, which orders the changes of one activity.

    The key fixes the partition of a message, so the offset decides.
    """
    number = F.col("offset").cast("decimal(38,0)") * F.lit(2**31) + F.col("partition")
    return number.cast("decimal(38,0)")


def latest_per_activity(changes: DataFrame) -> DataFrame:
    """The last change of each activity in stream order.

    Every task computes the largest place of each activity by hashing before the shuffle, whatever the
    number of changes of one activity; the rows then meet the short list of last places, each by id
    and place, so that the changes of one activity spread over all tasks. A message that was read
    twice appears twice.
    """
    placed = changes.withColumn("place", place())
    last = placed.groupBy("id_activite").agg(F.max("place").alias("place"))
    return placed.join(last, ["id_activite", "place"]).select(*changes.columns)


def latest_changes(change_messages: DataFrame) -> DataFrame:
    """The last accepted change of each activity, of messages that are parsed only if they survive.

    One pass reads nothing but the id of each message; every task keeps the last message of each activity
    before the shuffle, so what moves is a message per activity and task, however many changes one
    activity has. Where a last message turns out to be bad, all messages of its activity are parsed.
    """
    # A filter on the id would be pushed below and read every message twice; without an id, none is accepted.
    named = change_messages.where(F.col("value").isNotNull()).select(
        *POSITION, "value", _id_of("value").alias("id")
    )
    last = named.groupBy("id").agg(F.max_by(F.struct(*POSITION, "value"), place()).alias("m"))
    judged = written(parse(last.select("m.*")), "changes")
    bad = rejected(judged).select(_id_of("rejet").alias("id")).where(F.col("id").isNotNull())
    if bad.isEmpty():
        return accepted(judged)
    again = accepted(parse(named.join(bad, "id", "left_semi")))
    return accepted(judged).unionByName(latest_per_activity(again))


def _id_of(text: str) -> Column:
    return F.from_json(text, _ID)["id_activite"]


def announceable(activities: DataFrame, speed_limits: DataFrame) -> DataFrame:
    """New plausible activities of the announced sources."""
    new = activities.where(
        F.col("operation").isin(*L.ANNOUNCED_OPERATIONS)
        & F.col("source").isin(*L.ANNOUNCED_SOURCES)
    )
    valid = rules.is_valid(
        F.col("date_debut"), F.col("date_fin"), F.col("distance_m"), F.col("vitesse_max_kmh")
    )
    limited = new.join(speed_limits, "type_activite", "left").where(valid)
    return limited.drop("vitesse_max_kmh")


def announced_texts(new: DataFrame, names: DataFrame) -> DataFrame:
    """Text of each activity to announce: ``id_activite, texte``."""
    people = names.select("id_salarie", F.concat("prenom", F.lit(" "), "nom").alias("nom_complet"))
    text = messages.announcement(
        F.col("nom_complet"), F.col("type_activite"), F.col("date_debut"), F.col("date_fin"),
        F.col("distance_m"), F.col("commentaire"),
    )
    return new.join(people, "id_salarie", "left").select("id_activite", text.alias("texte"))


def to_messages(activities: DataFrame) -> DataFrame:
    """Activity rows as change messages, one per row; the id is the offset."""
    event = F.struct(
        "id_activite", "id_salarie",
        _iso(F.col("date_debut")).alias("date_debut"), _iso(F.col("date_fin")).alias("date_fin"),
        "type_activite", "distance_m", "commentaire", "source",
        _iso(F.col("cree_le")).alias("cree_le"),
        F.col("operation").alias("__op"),
        F.unix_millis("capture_le").alias("__source_ts_ms"),
    )
    return activities.select(
        F.lit(0).alias("partition"), F.col("id_activite").alias("offset"),
        F.to_json(event).alias("value"),
    )


def _iso(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
