"""Bindings: the domain's stored tables, derived from the given test tables.

Every expression here has a counterpart in ``catalog.oracle``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trailperks import labels as L
from trailperks.operators import marts, staging
from trailperks.params import Params
from trailperks.sources import seeds

AS_OF = date(2024, 1, 31)
AS_OF_TIME = datetime(2024, 1, 31, tzinfo=timezone.utc)


def _pick(key: Column, *values: object) -> Column:
    """The value at position ``key``, from 0."""
    return F.get(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), key.cast("int"))


@dataclass
class TestTables:
    """Raw and distance tables over one folder of test data."""

    __test__ = False

    spark: SparkSession
    folder: str
    _files: dict[str, DataFrame] = field(default_factory=dict)

    def read(self, name: str) -> DataFrame:
        """One file; its schema is read once."""
        if name not in self._files:
            self._files[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._files[name]

    # --- raw layer ----------------------------------------------------------------------------

    @cached_property
    def activities(self) -> DataFrame:
        return raw_activities(self.read("events"))

    @cached_property
    def salaries(self) -> DataFrame:
        key = F.col("c_custkey")
        hire_day = F.when(key % 17 == 0, 5127).otherwise((key * 37) % 5110).cast("int")
        return self.read("customer").select(
            key.cast("int").alias("id_salarie"),
            F.col("c_name").alias("nom"),
            F.concat(F.lit(" P"), (key % 10).cast("string"), F.lit(" ")).alias("prenom"),
            F.date_add(F.lit(date(1960, 1, 1)), ((key * 53) % 16000).cast("int"))
            .alias("date_naissance"),
            F.col("c_mktsegment").alias("bu"),
            F.date_add(F.lit(date(2010, 1, 1)), hire_day).alias("date_embauche"),
            (20000 + F.floor(F.abs("c_acctbal") * 4)).cast("int").alias("salaire_brut"),
            F.when(key % 6 == 0, "CDD").otherwise("CDI").alias("type_contrat"),
            F.lit(25).alias("jours_cp"),
            self._address().alias("adresse"),
            _pick(F.col("c_nationkey") % 4, *L.TRAVEL_MODES).alias("moyen_deplacement"),
            F.lit("rh.parquet").alias("fichier_source"),
            F.lit(datetime(2024, 1, 30, tzinfo=timezone.utc)).alias("charge_le"),
        )

    @staticmethod
    def _address() -> Column:
        key = F.col("c_custkey")
        postcode = F.when(key % 31 == 0, "").otherwise(
            F.concat((34000 + key % 50 * 10).cast("string"), F.lit(" "))
        )
        town = _pick(F.col("c_nationkey") % 5, "Montpellier", "Lattes", "Nîmes", "Mèze", "Pérols")
        return F.concat((key % 200).cast("string"), F.lit(" rue des Tests, "), postcode, town)

    @cached_property
    def sports(self) -> DataFrame:
        key = F.col("c_custkey")
        sport = _pick(
            key % 7, F.lit(None).cast("string"), "Runing", " Tennis ", "Natation", "Randonnée", "",
            "Triathlon",
        )
        return self.read("customer").select(
            key.cast("int").alias("id_salarie"),
            sport.alias("pratique_sport"),
            F.lit("sport.parquet").alias("fichier_source"),
            F.lit(datetime(2024, 1, 30, tzinfo=timezone.utc)).alias("charge_le"),
        )

    @cached_property
    def distances(self) -> DataFrame:
        key, mode = F.col("c_custkey"), F.col("c_nationkey") % 4
        lost = key % 23 == 0
        return (
            self.read("customer")
            .where(mode.isin(0, 1) & (key % 29 != 0))
            .select(
                key.cast("int").alias("id_salarie"),
                F.when(key % 19 == 0, "ancienne adresse").otherwise(self._address())
                .alias("adresse"),
                F.when(mode == 0, "WALK").otherwise("BICYCLE").alias("mode_api"),
                F.when(~lost, 500 + (key * 7919) % 30000).cast("int").alias("distance_m"),
                F.when(~lost, 300 + (key * 104729) % 14400).cast("int").alias("duree_s"),
                F.when(lost, L.ROUTE_NOT_FOUND).otherwise(L.ROUTE_FOUND).alias("statut"),
                F.lit(datetime(2024, 1, 15, tzinfo=timezone.utc)).alias("calcule_le"),
            )
        )

    @cached_property
    def speed_limits(self) -> DataFrame:
        return seeds.speed_limits(self.spark)

    @cached_property
    def towns(self) -> DataFrame:
        return seeds.example_towns(self.spark)

    # --- monitoring layer ---------------------------------------------------------------------

    @cached_property
    def pipeline_runs(self) -> DataFrame:
        """Run-log rows, one per order."""
        key = F.col("o_orderkey")
        ordered = F.col("o_orderdate").cast("timestamp")
        start = F.timestamp_add("SECOND", (key % 40000).cast("int"), ordered)
        return self.read("orders").select(
            key.cast("string").alias("id_run"),
            _pick(
                key % 6, "ingestion_salaries", "ingestion_sports", "geo_distances", L.LOADER_STEP,
                "modeles", "qualite",
            ).alias("etape"),
            start.alias("debut"),
            F.timestamp_add("SECOND", (key % 97).cast("int"), start).alias("fin"),
            F.when(F.col("o_orderstatus") == "O", L.RUN_OK)
            .when(F.col("o_orderstatus") == "F", L.RUN_FAILED)
            .otherwise(L.RUN_PENDING)
            .alias("statut"),
            F.floor("o_totalprice").cast("long").alias("nb_lignes"),
            F.concat(F.lit("commande "), key.cast("string")).alias("message"),
        )

    @cached_property
    def quality_checks(self) -> DataFrame:
        """Check outcomes, one per order line; the order is the run."""
        key, first_run = F.col("l_orderkey"), datetime(2024, 1, 1, tzinfo=timezone.utc)
        return self.read("lineitem").select(
            key.cast("string").alias("execution_id"),
            F.timestamp_add("SECOND", key.cast("int"), F.lit(first_run)).alias("verifie_le"),
            F.lit("entrepot").alias("data_source"),
            _pick(F.col("l_linenumber") % 3, "raw", "geo", "analytics").alias("fichier_controle"),
            _pick(F.col("l_suppkey") % 4, "activites", "salaries", "sports", "kpi_synthese")
            .alias("table_verifiee"),
            F.concat(F.lit("controle "), (F.col("l_partkey") % 35).cast("string")).alias("controle"),
            F.when(F.col("l_returnflag") == "R", L.CHECK_FAIL)
            .when(F.col("l_returnflag") == "A", L.CHECK_WARN)
            .otherwise(L.CHECK_PASS)
            .alias("resultat"),
            F.col("l_quantity").alias("valeur"),
        )

    # --- staging ------------------------------------------------------------------------------

    @cached_property
    def stg_activities(self) -> DataFrame:
        return staging.staged_activities(self.activities, self.speed_limits)

    @cached_property
    def stg_salaries(self) -> DataFrame:
        return staging.staged_salaries(self.salaries, AS_OF)

    @cached_property
    def stg_sports(self) -> DataFrame:
        return staging.staged_sports(self.sports)

    @cached_property
    def stg_distances(self) -> DataFrame:
        return staging.staged_distances(self.distances)

    # --- marts --------------------------------------------------------------------------------

    @cached_property
    def employee_base(self) -> DataFrame:
        return marts.employee_base(self.stg_salaries, self.stg_sports, self.stg_distances)

    def rollup(self, params: Params) -> DataFrame:
        start = params.period_start(AS_OF)
        daily = marts.daily_activity(self.stg_activities, start)
        return marts.activity_rollup(daily, self.stg_salaries, {"": start})

    def benefits(self, params: Params = Params()) -> DataFrame:
        return marts.benefit_mart(self.employee_base, self.rollup(params), params)

    def kpi(self, params: Params = Params()) -> DataFrame:
        return marts.kpi_summary(self.employee_base, self.rollup(params), params)

    @cached_property
    def activity_mart(self) -> DataFrame:
        return marts.activity_mart(self.stg_activities, self.stg_salaries, self.stg_sports)


def raw_activities(events: DataFrame) -> DataFrame:
    """Activities from events; also serves the streaming source."""
    key, start = F.col("event_id"), F.col("ts").cast("timestamp")
    seconds = F.when(key % 89 == 0, -600).otherwise(
        60 * F.regexp_extract("props", "([0-9]+)", 1).cast("int") + (key % 60).cast("int")
    )
    kind = F.col("event_type")
    metres = F.floor(F.col("value") * 100).cast("int")
    return events.select(
        key.alias("id_activite"),
        F.col("user_id").cast("int").alias("id_salarie"),
        start.alias("date_debut"),
        F.when(kind == "click", "Course à pied")
        .when(kind == "view", "Marche")
        .when(kind == "purchase", "Vélo")
        .when(kind == "signup", "Natation")
        .otherwise("Escalade")
        .alias("type_activite"),
        F.when(kind == "error", F.lit(None))
        .when(key % 97 == 0, -metres)
        .when(kind == "signup", F.floor(F.col("value") * 20).cast("int"))
        .otherwise(metres)
        .alias("distance_m"),
        F.timestamp_add("SECOND", seconds, start).alias("date_fin"),
        F.when(key % 5 == 0, "Belle séance !").alias("commentaire"),
        F.when(key % 10 == 0, "live").otherwise("backfill").alias("source"),
        start.alias("cree_le"),
        F.when(key % 10 == 0, "c").otherwise("r").alias("operation"),
        start.alias("capture_le"),
        F.timestamp_add("SECOND", F.lit(60), start).alias("charge_le"),
    )
