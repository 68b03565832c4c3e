"""The whole run over layer tables: order, gates, history, parameters."""

from datetime import datetime, timezone

import pytest
from compare import SMALL
from pyspark.sql import functions as F

from trailperks import labels as L, schemas
from trailperks.catalog.flows import answers, hr_file, sport_file
from trailperks.operators import audit, changes, marts, quality, staging
from trailperks.params import Params
from trailperks.plans import pipeline as P
from trailperks.plans.pipeline import Pipeline
from trailperks.sources.layers import Layers
from trailperks.sources.testdata import AS_OF_TIME, TestTables
from trailperks.streaming import loader


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Files and a loaded activity table; activities are kept plausible so the gate opens."""
    root = tmp_path_factory.mktemp("run")
    tables = TestTables(spark, SMALL)
    layers = Layers(spark, str(root / "layers"))
    for name, frame in (("rh", hr_file(tables)), ("sport", sport_file(tables))):
        frame.drop("fichier_source").write.csv(str(root / name), header=True, quoteAll=True,
                                               ignoreLeadingWhiteSpace=False,
                                               ignoreTrailingWhiteSpace=False)
    clean = tables.stg_activities.where("est_valide").select("id_activite")
    messages = changes.to_messages(tables.activities.join(clean, "id_activite", "left_semi"))
    loader.load_batch(layers, messages, 0)
    return layers, str(root / "rh"), str(root / "sport")


def run(loaded, params=None, **options):
    layers, hr, sport = loaded
    # The loader stamps its rows with the clock, so the run is dated now.
    pipe = Pipeline(layers, datetime.now(timezone.utc), params, **options)
    return pipe, pipe.run(hr, sport, answers)


def test_run_and_history(loaded, spark):
    layers = loaded[0]
    first, summary = run(loaded, Params(periode_jours=4000, nb_activites_min=5))
    row = summary.first()
    assert row["nb_salaries"] == 150 and row["nb_eligibles_bien_etre"] > 0
    assert layers.read(P.ACTIVITY_MART).count() == layers.read(P.ACTIVITY_MART).where(
        "est_valide").count()
    second, cheaper = run(loaded, Params(periode_jours=4000, nb_activites_min=5, taux_prime="0.03"))
    assert cheaper.first()["cout_prime"] < row["cout_prime"]
    assert {r["execution_id"] for r in second.history().collect()} == {
        first.execution_id, second.execution_id}
    steps = layers.read_log(audit.RUN_LOG, schemas.PIPELINE_RUNS)
    assert steps.where(F.col("statut") != L.RUN_OK).count() == 0
    names = [r["etape"] for r in steps.orderBy("debut").collect()][:9]
    assert names == ["ingestion_salaries", "ingestion_sports", "instantane_activites",
                     "geo_distances", "parametres", "qualite", "modeles", "tests", "qualite"]
    checks = layers.read_log(P.CHECKS, schemas.QUALITY_CHECKS)
    assert checks.count() == 2 * 35
    # The second run finds its distances in the store, but for the trips without a route.
    asked = [r["nb_lignes"] for r in steps.where("etape = 'geo_distances'").orderBy("debut").collect()]
    assert asked[1] < asked[0]


def test_marts_match_the_direct_plans(loaded, spark):
    """Layer tables hold the same benefits as the lazy plan over the same inputs."""
    layers = loaded[0]
    pipe, _ = run(loaded, Params(periode_jours=4000, nb_activites_min=5))
    activities, salaries = pipe.stg_activities(), pipe.stg_salaries()
    base = marts.employee_base(
        salaries, staging.staged_sports(layers.read("raw.sports")),
        staging.staged_distances(layers.read(P.DISTANCES)),
    )
    start = pipe.params.period_start(pipe.as_of.date())
    rollup = marts.activity_rollup(
        marts.daily_activity(activities, start), salaries, {"": start}
    )
    direct = marts.benefit_mart(base, rollup, pipe.params)
    stored = layers.read(P.BENEFITS)
    assert direct.exceptAll(stored).count() == 0 and stored.exceptAll(direct).count() == 0


def test_simulation_appends_one_row_per_set(loaded):
    pipe, summary = run(loaded, Params(periode_jours=4000, nb_activites_min=5))
    before = pipe.history().count()
    base = pipe.params
    rows = {r["execution_id"]: r for r in pipe.simulate({
        "meme": base, "cher": base.with_overrides(taux_prime="0.1"),
        "court": base.with_overrides(periode_jours=1),
    }).collect()}
    assert len(rows) == before + 3
    same = rows[f"{pipe.execution_id}-meme"].asDict()
    assert {k: same[k] for k in summary.columns} == summary.first().asDict()
    assert rows[f"{pipe.execution_id}-cher"]["cout_prime"] > same["cout_prime"]
    assert rows[f"{pipe.execution_id}-court"]["nb_activites_valides"] < same["nb_activites_valides"]


def test_full_refresh_empties_the_history(loaded):
    pipe, _ = run(loaded, Params(periode_jours=4000))
    pipe.build(full_refresh=True)
    assert [r["execution_id"] for r in pipe.history().collect()] == [pipe.execution_id]


def test_gate_stops_the_run(spark, tmp_path, loaded):
    """Many implausible activities: the run stops before the models."""
    _, hr, sport = loaded
    layers = Layers(spark, str(tmp_path / "layers"))
    tables = TestTables(spark, SMALL)
    loader.load_batch(layers, changes.to_messages(tables.activities), 0)
    alerts = []
    with pytest.raises(quality.QualityGateError):
        Pipeline(layers, AS_OF_TIME, alert=alerts.append).run(hr, sport, answers)
    assert len(alerts) == 1 and "échec(s)" in alerts[0]
    assert layers.version(P.BENEFITS) is None
    log = layers.read_log(audit.RUN_LOG, schemas.PIPELINE_RUNS)
    assert [r["etape"] for r in log.where("statut = 'echec'").collect()] == ["qualite"]
    failing = layers.read_log(P.CHECKS, schemas.QUALITY_CHECKS).where("resultat = 'fail'")
    assert failing.count() > 0


def test_result_mart_has_no_personal_columns(loaded):
    columns = loaded[0].read(P.BENEFITS).columns
    assert columns == list(marts.BENEFIT_COLUMNS) and len(columns) == 18
    assert not {"nom", "prenom", "adresse", "salaire_brut"} & set(columns)


def test_marts_that_fail_a_test_are_not_published(loaded, monkeypatch):
    layers = loaded[0]
    pipe, _ = run(loaded, Params(periode_jours=4000, nb_activites_min=5))
    tables = (P.ACTIVITY_MART, P.ROLLUP, P.BENEFITS, P.KPI)
    before = [layers.version(table) for table in tables]
    history, total = pipe.history().count(), layers.read(P.KPI).first()["cout_total"]
    sound = marts.benefit_mart

    def spoiled(*arguments):
        rows = sound(*arguments)
        return rows.withColumn("montant_prime", (-1 - F.col("montant_prime")).cast("decimal(18,2)"))

    monkeypatch.setattr(marts, "benefit_mart", spoiled)
    with pytest.raises(quality.QualityGateError, match="coûts cohérents"):
        pipe.build()
    assert [layers.version(table) for table in tables] == before
    assert pipe.history().count() == history and layers.read(P.KPI).first()["cout_total"] == total


def test_parameters_must_be_one_row(loaded):
    layers = loaded[0]
    pipe = Pipeline(layers, AS_OF_TIME)
    layers.reload(P.PARAMETERS, Params().row(layers.spark).union(Params().row(layers.spark)))
    with pytest.raises(quality.QualityGateError, match="one row"):
        pipe.effective_params()
    layers.reload(P.PARAMETERS, Params().row(layers.spark))


def test_stored_seeds_stay_without_files(loaded):
    layers = loaded[0]
    layers.reload(P.PARAMETERS, Params(taux_prime="0.04").row(layers.spark))
    Pipeline(layers, AS_OF_TIME).load_seeds()
    assert Pipeline(layers, AS_OF_TIME).effective_params().taux_prime == Params(taux_prime="0.04").taux_prime


@pytest.mark.parametrize("value", ["0.0000000000001", "2.1234567"])
def test_parameters_that_would_be_rounded_are_refused(value):
    with pytest.raises(ValueError, match="decimals"):
        Params(nb_jours_bien_etre=value)
