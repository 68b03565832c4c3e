"""The commands in their usual order, over small files."""

import json

import pytest

from test_stream import EVENT, event, lines
from trailperks import schemas
from trailperks.__main__ import main, overrides
from trailperks.params import Params
from trailperks.plans import pipeline as P
from trailperks.sources.layers import Layers
from trailperks.sources.reference_files import HR_FILE
from trailperks.streaming import announcer

PEOPLE = [
    '7,Dupont,Anne,1990-06-15,Marketing,2015-09-01,30000,CDI,25,"1 rue A, 34970 Lattes",'
    "Marche/running",
    '8,Durand,Paul,1970-01-01,Support,2012-03-01,40000,CDD,25,"2 rue B, 34970 Lattes",'
    "Transports en commun",
]


def test_commands(spark, tmp_path, capsys):
    root = str(tmp_path / "layers")
    layers = Layers(spark, root)

    def run(*arguments):
        return main(["--root", root, "--as-of", "2026-07-01T12:00:00", *arguments], spark)

    hr = tmp_path / "rh.csv"
    hr.write_text("\n".join([",".join(HR_FILE.columns), *PEOPLE]), encoding="utf-8")
    sports = tmp_path / "sport.csv"
    sports.write_text("ID salarié,Pratique d'un sport\n7,Runing\n8,\n", encoding="utf-8")
    assert run("ingest", "--hr", str(hr), "--sports", str(sports)) == 0
    assert run("seed") == 0

    topic = tmp_path / "topic"
    lines(topic, "1.json", *[(i, event(id_activite=i)) for i in range(20)])
    lines(topic, "2.json", (20, event(id_activite=99, source="backfill")))
    assert run("load", "--files", str(topic), "--checkpoint", str(tmp_path / "c1")) == 0
    assert run("compact") == 0
    assert run("announce", "--files", str(topic), "--checkpoint", str(tmp_path / "c2"),
               "--dry-run") == 0
    assert "Anne Dupont" in capsys.readouterr().out
    assert announcer.outbox(layers).count() == 0
    assert run("announce", "--files", str(topic), "--checkpoint", str(tmp_path / "c2")) == 0
    assert announcer.outbox(layers).count() == 20

    assert run("request-distances", "--out", str(tmp_path / "asked")) == 0
    asked = spark.read.json(str(tmp_path / "asked")).collect()
    assert [(r["mode_api"], r["lot"], r["origines"]) for r in asked] == [
        ("WALK", 0, ["1 rue A, 34970 Lattes, France"])]
    (tmp_path / "answers").mkdir()
    elements = [{"distanceMeters": 3000, "duration": "2400s", "condition": "ROUTE_EXISTS"}]
    answer = {"mode_api": "WALK", "lot": 0, "reponse": json.dumps(elements)}
    (tmp_path / "answers" / "1.json").write_text(json.dumps(answer), encoding="utf-8")
    assert run("store-distances", "--answers", str(tmp_path / "answers")) == 0
    assert "ROUTE_EXISTS" in capsys.readouterr().out
    assert run("request-distances", "--out", str(tmp_path / "again")) == 0
    assert "0 trips" in capsys.readouterr().out
    assert run("build", "--set", "taux_prime=0.1", "seuil_velo_km=") == 0
    kpi = layers.read(P.KPI).first()
    assert kpi["nb_eligibles_prime"] == 1 and float(kpi["cout_prime"]) == 3000
    assert kpi["nb_eligibles_bien_etre"] == 1 and kpi["nb_activites_valides"] == 21
    assert run("check", "--layers", "analytics", "--details") == 0
    assert "pass | kpi_synthese" in capsys.readouterr().out

    lines(topic, "3.json", *[(100 + i, event(id_activite=200 + i, distance_m=-1))
                             for i in range(60)])
    assert run("load", "--files", str(topic), "--checkpoint", str(tmp_path / "c1")) == 0
    assert run("compact") == 0
    assert run("check", "--layers", "raw") == 1
    shown = capsys.readouterr()
    assert "fail | activites | % de distances hors bornes" in shown.out
    assert "échec(s)" in shown.err

    sports.write_text("ID salarié,Pratique d'un sport\n7,Runing\n7,\n", encoding="utf-8")
    assert run("ingest", "--hr", str(hr), "--sports", str(sports)) == 1
    assert layers.read("raw.sports").count() == 2


def test_overrides():
    assert overrides(["taux_prime=0.03", "seuil_velo_km="]) == Params(taux_prime="0.03")
    with pytest.raises(ValueError):
        overrides(["inconnu=1"])


def test_event_fixture_is_complete():
    assert set(EVENT) == set(schemas.CHANGE_EVENT.fieldNames())
