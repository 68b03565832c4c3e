"""The nightly run: ingest, distances, gate on the sources, models, gate on the results."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from trailperks import labels as L, schemas
from trailperks.operators import audit, assertions, distances, marts, quality, staging
from trailperks.params import Params, params_from_row
from trailperks.session import cut_lineage
from trailperks.sources import seeds, views
from trailperks.sources.layers import Layers
from trailperks.sources.reference_files import HR_FILE, SPORT_FILE, full_reload
from trailperks.streaming import loader

DISTANCES = "geo.distances_domicile_travail"
TRIPS = "geo.trajets_a_calculer"
QUARANTINE = "geo.lots_en_quarantaine"
ROLLUP = "staging.activites_par_salarie"
ACTIVITY_MART = "analytics.activites"
BENEFITS = "analytics.avantages_salaries"
KPI = "analytics.kpi_synthese"
KPI_HISTORY = "analytics.historique_kpi"
PARAMETERS = "analytics.parametres"
SPEED_LIMITS = "analytics.vitesses_max"
TOWNS = "geo.communes"
CHECKS = "monitoring.qualite_checks"

# Answers a frame of numbered trips with ``mode_api, lot, reponse``: the call of the distance service.
RouteService = Callable[[DataFrame], DataFrame]


@dataclass
class Pipeline:
    """One run over the layer tables. Every step is logged; a failing step stops the run."""

    layers: Layers
    as_of: datetime
    params: Params | None = None
    force_distances: bool = False
    alert: Callable[[str], None] | None = None

    def __post_init__(self) -> None:
        self.spark = self.layers.spark
        self.execution_id = uuid.uuid4().hex
        # Identifier of the last check run.
        self.check_id: str | None = None

    def _log(self, step: str, work: Callable[[], int | None]) -> int | None:
        return audit.logged_step(self.layers, step, work)

    # --- sources ------------------------------------------------------------------------------

    def snapshot_activities(self) -> None:
        """Fold the change journal once, so that no later step has to."""
        self._log("instantane_activites", lambda: loader.compact(self.layers))

    def ingest(self, hr_path: str, sport_path: str, kind: str = "csv") -> None:
        full_reload(self.layers, hr_path, HR_FILE, self.as_of, kind)
        full_reload(self.layers, sport_path, SPORT_FILE, self.as_of, kind)

    def request_distances(self) -> int:
        """Number the open trips and keep the numbering, to which the answers will refer."""
        stored = self.layers.read_or_empty(DISTANCES, schemas.DISTANCES)
        salaries = self.layers.read(HR_FILE.table)
        todo = cut_lineage(distances.worklist(salaries, stored, self.force_distances))
        self.layers.reload(TRIPS, distances.lots(todo))
        return self.layers.read(TRIPS).count()

    def store_distances(self, answers: DataFrame) -> int:
        """Replace the stored distances of the answered trips; other lots are kept aside and logged."""

        def work() -> int:
            numbered = self.layers.read(TRIPS)
            stored = self.layers.read_or_empty(DISTANCES, schemas.DISTANCES)
            computed = cut_lineage(distances.parse_answers(numbered, answers))
            self.layers.reload(DISTANCES, distances.upsert(stored, computed, self.as_of))
            aside = cut_lineage(distances.quarantined(numbered, answers))
            self.layers.reload(QUARANTINE, aside)
            lost = aside.agg(F.count(F.lit(1)), F.sum("trajets")).first()
            if lost[0]:
                moment = datetime.now(timezone.utc)
                message = f"{lost[0]} lots ({lost[1]} trips) without a readable answer"
                audit.log_step(
                    self.layers, "geo_quarantaine", moment, moment, L.RUN_FAILED, lost[1], message
                )
            return computed.count()

        return self._log("geo_distances", work)

    def compute_distances(self, service: RouteService) -> int:
        """Ask the service for the open trips and store its answers."""
        if not self.request_distances():
            return 0
        return self.store_distances(service(self.layers.read(TRIPS)))

    def load_seeds(
        self, parameters: str | None = None, limits: str | None = None, towns: str | None = None
    ) -> None:
        """Store the seeds of the given files; the defaults fill what was never stored. Towns have no default."""

        def work() -> int:
            written = 0
            for table, path, read in (
                (PARAMETERS, parameters, seeds.parameters), (SPEED_LIMITS, limits, seeds.speed_limits),
                (TOWNS, towns, seeds.towns),
            ):
                if path or (table != TOWNS and self.layers.version(table) is None):
                    self.layers.reload(table, read(self.spark, path))
                    written += 1
            return written

        self._log("parametres", work)

    # --- inputs of the models -----------------------------------------------------------------

    def effective_params(self) -> Params:
        """Run-time parameters, else the one stored row."""
        if self.params:
            return self.params
        rows = self.layers.read(PARAMETERS).limit(2).collect()
        if len(rows) != 1:
            raise quality.QualityGateError("the parameter table must have one row")
        return params_from_row(rows[0].asDict())

    def raw_activities(self) -> DataFrame:
        """The activities as of the snapshot of this run, whatever the stream adds meanwhile."""
        return self.layers.read(loader.ACTIVITIES).select(*schemas.RAW_ACTIVITIES.fieldNames())

    def stg_activities(self) -> DataFrame:
        return staging.staged_activities(self.raw_activities(), self.layers.read(SPEED_LIMITS))

    def stg_salaries(self) -> DataFrame:
        return staging.staged_salaries(self.layers.read(HR_FILE.table), self.as_of.date())

    def sql_views(self) -> None:
        """Views over the newest tables and the rules with the parameters in force, for SQL in this session."""
        read = self.layers.read
        raw = {
            "salaries": read(HR_FILE.table), "sports": read(SPORT_FILE.table), "distances": read(DISTANCES),
            "activites": self.raw_activities(), "vitesses_max": read(SPEED_LIMITS),
        }
        views.create_views(raw, self.as_of.date())
        views.create_functions(self.spark, self.effective_params())

    # --- gates --------------------------------------------------------------------------------

    def check(self, *checked_layers: str) -> dict[str, int]:
        """Run the checks of the given layers, store the outcomes, stop on a failure."""
        started = datetime.now(timezone.utc)
        tables = self._tables(checked_layers)
        chosen = [c for c in quality.standard_checks(self.as_of) if c.layer in checked_layers]
        limited = {}
        if "activites" in tables:
            limits = self.layers.read(SPEED_LIMITS)
            limited["activites"] = tables["activites"].join(limits, "type_activite", "left")
        outcomes = cut_lineage(quality.evaluate(self.spark, tables, chosen, limited))
        self.check_id = uuid.uuid4().hex
        self.layers.append(CHECKS, quality.stored(outcomes, self.check_id, self.as_of))
        counts = quality.outcome_counts(outcomes.collect())
        status, message = quality.run_status(counts), quality.run_message(counts)
        audit.log_step(
            self.layers, "qualite", started, datetime.now(timezone.utc), status, len(chosen), message
        )
        if status == L.RUN_FAILED:
            raise quality.QualityGateError(message)
        return counts

    def _tables(self, checked_layers: tuple[str, ...]) -> dict[str, DataFrame]:
        read = self.layers.read
        tables = {"salaries": read(HR_FILE.table)}
        if "raw" in checked_layers:
            tables |= {"activites": self.raw_activities(), "sports": read(SPORT_FILE.table)}
        if "geo" in checked_layers:
            tables["distances_domicile_travail"] = read(DISTANCES)
        if "analytics" in checked_layers:
            tables |= {
                "avantages_salaries": read(BENEFITS),
                "kpi_synthese": read(KPI),
                "parametres": read(PARAMETERS),
            }
        return tables

    # --- models -------------------------------------------------------------------------------

    def build(self, full_refresh: bool = False) -> None:
        """Compute the marts, test them, and only then publish them and extend the history.

        The counts per employee come from the written activity mart. Marts that fail a test are
        deleted; the published ones and the history stay as they were.
        """

        def work() -> int:
            params = self.effective_params()
            staged: dict[str, str] = {}

            def stage(table: str, rows: DataFrame, **how) -> DataFrame:
                staged[table] = self.layers.stage(table, rows, **how)
                return self.layers.staged(table, staged[table])

            salaries = self.stg_salaries()
            sports = staging.staged_sports(self.layers.read(SPORT_FILE.table))
            commutes = staging.staged_distances(self.layers.read(DISTANCES))
            try:
                # Month folders let later period filters skip files.
                mart = stage(
                    ACTIVITY_MART, marts.activity_mart(self.stg_activities(), salaries, sports),
                    partition_by=("mois",),
                )
                start = params.period_start(self.as_of.date())
                daily = marts.daily_activity(mart, start)
                rollup = stage(ROLLUP, marts.activity_rollup(daily, salaries, {"": start}))
                base = marts.employee_base(salaries, sports, commutes)
                benefits = stage(BENEFITS, marts.benefit_mart(base, rollup, params))
                kpi = stage(KPI, marts.kpi_summary(base, rollup, params))
                self.test_models(benefits, mart, kpi)
            except Exception:
                for table, folder in staged.items():
                    self.layers.delete(f"{self.layers.path(table)}/{folder}")
                raise
            for table, folder in staged.items():
                self.layers.publish(table, folder)
            history = marts.kpi_history(kpi, self.execution_id, self.as_of)
            if full_refresh:
                self.layers.replace_log(KPI_HISTORY, history)
            else:
                self.layers.append(KPI_HISTORY, history)
            return 5

        self._log("modeles", work)

    def simulate(self, scenarios: dict[str, Params]) -> DataFrame:
        """Compute the summary for several parameter sets in one job and append them to the history.

        The distances are facts and stay as they are; only the rules are applied again.
        """

        def work() -> int:
            sports = staging.staged_sports(self.layers.read(SPORT_FILE.table))
            commutes = staging.staged_distances(self.layers.read(DISTANCES))
            salaries = self.stg_salaries()
            summaries = marts.kpi_scenarios(
                marts.employee_base(salaries, sports, commutes), salaries,
                self.layers.read(ACTIVITY_MART), scenarios, self.as_of.date(),
            )
            run_id = F.concat(F.lit(f"{self.execution_id}-"), F.col("scenario"))
            history = marts.kpi_history(summaries, run_id, self.as_of)
            self.layers.append(KPI_HISTORY, history.drop("scenario"))
            return len(scenarios)

        self._log("simulation", work)
        return self.history()

    def history(self) -> DataFrame:
        """All recorded summaries."""
        return self.layers.read_log(KPI_HISTORY, marts.kpi_history_schema(self.layers.read(KPI)))

    def test_models(
        self, benefits: DataFrame | None = None, mart: DataFrame | None = None,
        kpi: DataFrame | None = None,
    ) -> dict[str, int]:
        """Test the given marts, or the published ones; errors stop the run, warnings are counted."""
        read = self.layers.read
        benefits = read(BENEFITS) if benefits is None else benefits
        mart = read(ACTIVITY_MART) if mart is None else mart
        kpi = read(KPI) if kpi is None else kpi
        tables = {
            "salaries": read(HR_FILE.table), "sports": read(SPORT_FILE.table),
            "activites": self.raw_activities(), "distances_domicile_travail": read(DISTANCES),
            "vitesses_max": read(SPEED_LIMITS),
        }
        started = datetime.now(timezone.utc)
        found = assertions.model_tests(
            tables, benefits, mart, kpi, mart, self.stg_salaries(), self.effective_params(),
        )
        broken = found.where(F.col("violations") > 0).collect()
        errors = sorted(r["test"] for r in broken if r["gravite"] == assertions.ERROR)
        warnings = len(broken) - len(errors)
        message = f"{len(errors)} erreur(s), {warnings} avertissement(s)"
        if errors:
            message += " : " + ", ".join(errors)
        status = L.RUN_FAILED if errors else L.RUN_OK
        audit.log_step(
            self.layers, "tests", started, datetime.now(timezone.utc), status, None, message
        )
        if errors:
            raise quality.QualityGateError(message)
        return {"errors": 0, "warnings": warnings}

    def run(
        self, hr_path: str, sport_path: str, service: RouteService, kind: str = "csv",
        full_refresh: bool = False, parameters: str | None = None, limits: str | None = None,
    ) -> DataFrame:
        """All steps in order; returns the summary. A failure is reported and raised.

        Seeds are read from the given files; without a file, the stored tables stay, and the defaults
        fill what was never stored.
        """
        try:
            self.ingest(hr_path, sport_path, kind)
            self.snapshot_activities()
            self.compute_distances(service)
            self.load_seeds(parameters, limits)
            self.check("raw", "geo")
            self.build(full_refresh)
            self.check("analytics")
        except Exception as problem:
            if self.alert:
                self.alert(f"Échec du traitement {self.execution_id} : {problem}")
            raise
        return self.layers.read(KPI)
