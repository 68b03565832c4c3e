"""Answers of a geocoding service: ranked candidates for a town name, and the cache of chosen towns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from trailperks import schemas
from trailperks.functions import text

#: The JSON list of candidates that answers a request, best first in the order of the service.
CANDIDATES = T.ArrayType(T.StructType([
    T.StructField("nom", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("centre", T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))])),
    T.StructField("codesPostaux", T.ArrayType(T.StringType())),
]))
#: One answer: the town as the address names it, its department if known, and the JSON text.
ANSWER = "commune string, departement string, reponse string"


def places_to_ask(people: DataFrame, cache: DataFrame) -> DataFrame:
    """Towns and departments of the addresses that the cache does not hold."""
    places = people.select("commune", "departement").dropna(subset=["commune"]).distinct()
    known = cache.select(F.col("commune").alias("c"), F.col("departement").alias("d"))
    same = F.col("commune").eqNullSafe(F.col("c")) & F.col("departement").eqNullSafe(F.col("d"))
    return places.join(known, same, "left_anti")


def candidates(answers: DataFrame) -> DataFrame:
    """``commune, departement, rang, exact`` and the columns of a candidate; those of the asked name come first.

    Names are compared by collation, so accents and case of any script do not matter, nor do hyphens and
    apostrophes. An unreadable answer has no candidates.
    """
    listed = answers.select(
        "commune", "departement", F.posexplode(F.from_json("reponse", CANDIDATES)).alias("place", "c")
    ).where(F.col("c.nom").isNotNull())
    exact = text.folded_name(F.col("c.nom")) == text.folded_name(F.col("commune"))
    return listed.select(
        "commune", "departement", "place", exact.alias("exact"),
        F.col("c.nom").alias("nom_officiel"), F.col("c.code").alias("code_insee"),
        F.get("c.centre.coordinates", 1).alias("lat"), F.get("c.centre.coordinates", 0).alias("lon"),
        F.array_join(F.coalesce("c.codesPostaux", F.array()), "|").alias("codes_postaux"),
    )


def chosen(found: DataFrame) -> DataFrame:
    """The candidate of each place: the first one of exactly that name, else the first one.

    An answer is a short list, so the choice is a minimum that every task takes before the shuffle.
    """
    columns = [name for name in schemas.TOWNS.fieldNames() if name not in ("commune", "departement")]
    order = F.when(F.col("exact"), 0).otherwise(1) * F.lit(2**31) + F.col("place")
    first = found.groupBy("commune", "departement").agg(F.min_by(F.struct(*columns), order).alias("c"))
    return first.select("commune", "departement", "c.*").select(*schemas.TOWNS.fieldNames())


def unanswered(asked: DataFrame, found: DataFrame) -> DataFrame:
    """Places for which the service knows no town."""
    known = found.select(F.col("commune").alias("c"), F.col("departement").alias("d"))
    same = F.col("commune").eqNullSafe(F.col("c")) & F.col("departement").eqNullSafe(F.col("d"))
    return asked.join(known, same, "left_anti")


def coordinates(answer: Column) -> Column:
    """Latitude and longitude of the first place in the answer to a precise address."""
    kind = "struct<features: array<struct<geometry: struct<coordinates: array<double>>>>>"
    place = F.get(F.from_json(answer, kind)["features"], F.lit(0))["geometry"]["coordinates"]
    return F.struct(F.get(place, F.lit(1)).alias("lat"), F.get(place, F.lit(0)).alias("lon"))
