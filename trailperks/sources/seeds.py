"""Seeds: small typed reference tables, from the defaults or from a CSV file."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from trailperks import labels as L, schemas
from trailperks.params import PARAM_TYPE, Params, small_table
from trailperks.session import written

# Centres of the towns in the test addresses, as the geocoding cache holds them.
TOWN_ROWS = (
    ("Nîmes", "30", "Nîmes", "30189", 43.8322, 4.3429, "30000|30900"),
    ("Lattes", "34", "Lattes", "34129", 43.567, 3.899, "34970"),
    ("Pérols", "34", "Pérols", "34198", 43.5609, 3.9512, "34470"),
    ("Mèze", "34", "Mèze", "34157", 43.4323, 3.5843, "34140"),
    ("Montpellier", "34", "Montpellier", "34172", 43.61, 3.8742, "34000|34070|34080|34090"),
    ("Montpellier", None, "Montpellier", "34172", 43.61, 3.8742, "34000|34070|34080|34090"),
)
# Town whose centre stands for the company when its address has no coordinates.
COMPANY_TOWN = "Lattes"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file with a header and a declared schema; nothing is inferred, so leading zeros stay."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False)


BAD_ROW = "ligne_illisible"


def checked_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The typed rows of a seed file, and the lines that do not fit the declared types or number of columns."""
    wide = T.StructType([*schema.fields, T.StructField(BAD_ROW, T.StringType())])
    rows = spark.read.csv(
        path, schema=wide, header=True, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_ROW
    )
    # Kept first: Spark does not read the bad lines of a file alone.
    rows, bad = written(rows, "seed"), F.col(BAD_ROW).isNotNull()
    return rows.where(~bad).drop(BAD_ROW), rows.where(bad).select(BAD_ROW)


def speed_limits(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Highest plausible speed per activity type."""
    if path:
        return read_csv(spark, path, schemas.SPEED_LIMITS)
    rows = [(kind, Decimal(limit)) for kind, limit in L.SPEED_LIMITS_KMH.items()]
    return small_table(spark, rows, schemas.SPEED_LIMITS)


def towns(spark: SparkSession, path: str) -> DataFrame:
    """Town centres and postcodes of a geocoding cache; towns that are not in it have no distance."""
    return read_csv(spark, path, schemas.TOWNS)


def example_towns(spark: SparkSession) -> DataFrame:
    """The towns of the test addresses."""
    return small_table(spark, list(TOWN_ROWS), schemas.TOWNS)


def parameters(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The one-row parameter table."""
    if path:
        schema = T.StructType([T.StructField(n, PARAM_TYPE) for n in L.DEFAULT_PARAMS])
        return read_csv(spark, path, schema)
    return Params().row(spark)
