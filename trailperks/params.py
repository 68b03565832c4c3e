"""Rule parameters: defaults, run-time overrides, one-row table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields, replace
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from trailperks.labels import DEFAULT_PARAMS

# Decimals that a parameter may have; the rate is a factor of salaries and may be finer.
DECIMALS = 6
RATE_DECIMALS = 12
PARAM_TYPE = T.DecimalType(24, RATE_DECIMALS)


def _default(name: str) -> Decimal:
    return Decimal(DEFAULT_PARAMS[name])


@dataclass(frozen=True)
class Params:
    """The seven rule parameters, all numeric.

    They reach the plans as literals, so the period bound is a constant that Spark can push into the
    scan of the activity table.
    """

    taux_prime: Decimal = _default("taux_prime")
    seuil_marche_km: Decimal = _default("seuil_marche_km")
    seuil_velo_km: Decimal = _default("seuil_velo_km")
    nb_jours_bien_etre: Decimal = _default("nb_jours_bien_etre")
    nb_activites_min: Decimal = _default("nb_activites_min")
    jours_travailles_an: Decimal = _default("jours_travailles_an")
    periode_jours: Decimal = _default("periode_jours")

    def __post_init__(self) -> None:
        for field in fields(self):
            value = Decimal(str(getattr(self, field.name)))
            allowed = RATE_DECIMALS if field.name == "taux_prime" else DECIMALS
            if abs(value) >= 10**9 or value != round(value, allowed):
                raise ValueError(f"{field.name}: {value} needs more than {allowed} decimals or 9 digits")
            object.__setattr__(self, field.name, value)

    def with_overrides(self, **values: object) -> Params:
        """Replace the given parameters; ``None`` keeps the current value."""
        given = {name: value for name, value in values.items() if value is not None}
        unknown = set(given) - {field.name for field in fields(self)}
        if unknown:
            raise ValueError(f"unknown parameters: {sorted(unknown)}")
        return replace(self, **given)

    def period_start(self, as_of: date) -> date:
        days = int(self.periode_jours.to_integral_value(rounding=ROUND_HALF_UP))
        return as_of - timedelta(days=days)

    def row(self, spark: SparkSession) -> DataFrame:
        return params_table(spark, [self])


def small_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A handful of driver-side rows as a local relation.

    Spark knows the size of a local relation, so it can choose a broadcast join by itself.
    """
    names = schema.fieldNames()
    records = [dict(zip(names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records), schema)


def params_table(spark: SparkSession, rows: list[Params]) -> DataFrame:
    schema = T.StructType([T.StructField(field.name, PARAM_TYPE) for field in fields(Params)])
    return small_table(spark, [tuple(asdict(row).values()) for row in rows], schema)


def params_from_row(row: Mapping[str, object]) -> Params:
    """Parameters from a stored row; empty cells keep the defaults."""
    return Params().with_overrides(**{field.name: row[field.name] for field in fields(Params)})
