"""Commute distances: work-list, request lots, answers, update of the stored distances."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from trailperks import labels as L, schemas
from trailperks.functions import rules
from trailperks.functions.numbers import int_div

# Ids are numbered within ranges of this width: one range is the most that one window group holds.
ID_RANGE = 65536


def active_trips(salaries: DataFrame) -> DataFrame:
    """Commutes that need a distance. Travel modes are compared as stored, without trimming."""
    return salaries.where(F.col("moyen_deplacement").isin(*L.ROUTE_MODES)).select(
        "id_salarie", "adresse", rules.route_mode(F.col("moyen_deplacement")).alias("mode_api")
    )


def worklist(salaries: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
    """Trips without a found route for the same address and mode, in id order; all of them with ``force``."""
    trips = active_trips(salaries)
    if not force:
        found = stored.where(F.col("statut") == L.ROUTE_FOUND)
        keys = ["id_salarie", "adresse", "mode_api"]
        trips = trips.join(found.select(*keys), keys, "left_anti")
    return trips.orderBy(F.asc_nulls_last("id_salarie"), "adresse")


def lots(trips: DataFrame, size: int = L.ROUTE_LOT_SIZE) -> DataFrame:
    """Number the trips of each mode in id order and cut them into lots: ``lot, position``.

    There are two modes only, so numbering a whole mode in one window would put half of the trips in
    one task. Trips are counted per id range, the range totals are accumulated (there are at most
    2**32 / ID_RANGE ranges), and rows are numbered inside their range.
    """
    # Trips without id come last.
    ranged = trips.withColumn(
        "plage", F.coalesce(F.floor(F.col("id_salarie") / ID_RANGE).cast("int"), F.lit(2**31 - 1))
    )
    before = Window.partitionBy("mode_api").orderBy("plage").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        ranged.groupBy("mode_api", "plage")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("mode_api", "plage", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("debut"))
    )
    inside = Window.partitionBy("mode_api", "plage").orderBy(F.asc_nulls_last("id_salarie"), "adresse")
    rank = F.col("debut") + F.row_number().over(inside) - 1
    return ranged.join(offsets, ["mode_api", "plage"]).select(
        "id_salarie", "adresse", "mode_api",
        int_div(rank, F.lit(size)).alias("lot"),
        (rank % size).cast("int").alias("position"),
    )


def requests(numbered: DataFrame) -> DataFrame:
    """One row per lot with its origins in order; a lot holds at most the lot size."""
    origin = F.struct("position", F.concat("adresse", F.lit(L.ADDRESS_SUFFIX)).alias("origine"))
    return numbered.groupBy("mode_api", "lot").agg(
        F.array_sort(F.collect_list(origin)).getField("origine").alias("origines")
    )


def _readable(answers: DataFrame) -> DataFrame:
    """The answers with their elements; NULL where the text is not the JSON list of a lot."""
    elements = F.from_json("reponse", schemas.ROUTE_ELEMENTS)
    is_list = F.startswith(F.ltrim("reponse"), F.lit("["))
    return answers.select("mode_api", "lot", "reponse", F.when(is_list, elements).alias("elements"))


def quarantined(numbered: DataFrame, answers: DataFrame) -> DataFrame:
    """Lots without a readable answer: ``mode_api, lot, trajets, motif, reponse``."""
    sizes = numbered.groupBy("mode_api", "lot").agg(F.count(F.lit(1)).alias("trajets"))
    unread = _readable(answers).where("elements is not null").select("mode_api", "lot")
    texts = answers.groupBy("mode_api", "lot").agg(F.max("reponse").alias("reponse"))
    return (
        sizes.join(unread, ["mode_api", "lot"], "left_anti")
        .join(texts, ["mode_api", "lot"], "left")
        .withColumn("motif", F.when(F.col("reponse").isNull(), L.LOT_ABSENT).otherwise(L.LOT_UNREADABLE))
        .select("mode_api", "lot", "trajets", "motif", "reponse")
    )


def parse_answers(numbered: DataFrame, answers: DataFrame) -> DataFrame:
    """Distance rows from the JSON answer of each lot (``mode_api, lot, reponse``).

    Each trip takes the last element with its origin index (no index means 0). A trip without
    element in a readable answer is unanswered; an element with an error code carries the code as
    status. Lots without a readable answer give no rows, so that stored distances stay.
    """
    elements = _readable(answers).where("elements is not null").drop("reponse")
    own = F.filter(
        F.coalesce("elements", F.array()),
        lambda e: F.coalesce(e["originIndex"], F.lit(0)) == F.col("position"),
    )
    answer = F.col("element")
    code = answer["status"]["code"]
    seconds = F.nullif(F.rtrim(answer["duration"], F.lit("s")), F.lit("")).cast("int")
    status = (
        F.when(answer.isNull(), L.ROUTE_NO_ANSWER)
        .when(code != 0, F.concat(F.lit(L.ROUTE_ERROR_PREFIX), code.cast("string")))
        .otherwise(F.coalesce(answer["condition"], F.lit(L.ROUTE_UNKNOWN)))
    )
    return (
        numbered.join(elements, ["mode_api", "lot"])
        .withColumn("element", F.try_element_at(own, F.lit(-1)))
        .select(
            "id_salarie", "adresse", "mode_api",
            answer["distanceMeters"].alias("distance_m"),
            seconds.alias("duree_s"),
            status.alias("statut"),
        )
    )


def upsert(stored: DataFrame, computed: DataFrame, as_of: datetime) -> DataFrame:
    """Stored distances with the computed ones in place of the old rows of the same employees."""
    fresh = computed.withColumn("calcule_le", F.lit(as_of).cast("timestamp"))
    kept = stored.join(fresh.select("id_salarie"), "id_salarie", "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)


def suspects_preview(computed: DataFrame) -> DataFrame:
    """Trips beyond the preview limit in raw metres, longest first."""
    limit = rules.commute_limit_km(
        F.col("mode_api"), F.lit(L.PREVIEW_LIMIT_M["WALK"]), F.lit(L.PREVIEW_LIMIT_M["BICYCLE"])
    )
    over = computed.where(F.col("distance_m") > limit)
    return over.orderBy(F.desc("distance_m"), "id_salarie").select(
        "id_salarie", "mode_api", "distance_m"
    )
