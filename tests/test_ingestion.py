"""Reference files: structural refusals, typing, atomic reload, run log."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from trailperks import labels as L, schemas
from trailperks.operators import audit
from trailperks.sources import reference_files as files, seeds
from trailperks.sources.reference_files import HR_FILE, SPORT_FILE, InvalidFileError

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
HR_HEADER = ",".join(HR_FILE.columns)
HR_ROW = (
    '7, Dupont ,Anne,1990-06-15,Marketing,2015-09-01,30330,CDI,25,"1 rue A, 34970 Lattes",'
    "Marche/running"
)


def write(path, *lines):
    path.write_text("\n".join(lines), encoding="utf-8")
    return str(path)


def sport_file(tmp_path, *rows, header="ID salarié,Pratique d'un sport"):
    return write(tmp_path / "sport.csv", header, *rows)


def test_hr_file(spark, tmp_path):
    path = write(tmp_path / "rh.csv", HR_HEADER, HR_ROW)
    table = files.read_validated(spark, path, HR_FILE, NOW)
    assert table.schema.fieldNames() == schemas.RAW_SALARIES.fieldNames()
    assert [f.dataType for f in table.schema] == [f.dataType for f in schemas.RAW_SALARIES]
    row = table.first()
    assert (row["id_salarie"], row["date_naissance"], row["salaire_brut"]) == (
        7, date(1990, 6, 15), 30330)
    assert row["adresse"] == "1 rue A, 34970 Lattes" and row["fichier_source"] == "rh.csv"


def test_blank_and_missing_sports(spark, tmp_path):
    path = sport_file(tmp_path, "1,Tennis", "2,", '3,"Runing"')
    rows = files.read_validated(spark, path, SPORT_FILE, NOW).orderBy("id_salarie").collect()
    assert [r["pratique_sport"] for r in rows] == ["Tennis", None, "Runing"]


def test_nan_becomes_null(spark):
    frame = spark.createDataFrame(
        [(1, float("nan")), (2, 3.0)], "`ID salarié` int, `Pratique d'un sport` double"
    ).withColumn("fichier_source", F.lit("f"))
    rows = files.typed(frame, SPORT_FILE, NOW).orderBy("id_salarie").collect()
    assert [r["pratique_sport"] for r in rows] == [None, "3.0"]


@pytest.mark.parametrize("rows, header, message", [
    (["1,Tennis"], "ID salarié,Sport", "missing columns"),
    ([], "ID salarié,Pratique d'un sport", "no rows"),
    (["1,Tennis", ",Boxe"], "ID salarié,Pratique d'un sport", "1 rows without id"),
    (["1,Tennis", "1,Boxe", "10,Judo", "10,", "9,"], "ID salarié,Pratique d'un sport",
     "2 repeated ids"),
    (["7,a", "07,b", " 7 ,c", "8,d"], "ID salarié,Pratique d'un sport", "1 repeated ids"),
    (["7,a", "  ,b"], "ID salarié,Pratique d'un sport", "1 rows without id"),
    (["7,a", "x7,b"], "ID salarié,Pratique d'un sport", "1 rows with an unreadable id"),
])
def test_refused_files(spark, tmp_path, rows, header, message):
    with pytest.raises(InvalidFileError, match=message):
        files.read_validated(spark, sport_file(tmp_path, *rows, header=header), SPORT_FILE, NOW)


def test_all_repeated_ids_are_listed(spark, tmp_path):
    rows = [f"{i},x" for i in range(50)] * 2
    with pytest.raises(InvalidFileError, match="50 repeated ids") as problem:
        files.read_validated(spark, sport_file(tmp_path, *rows), SPORT_FILE, NOW)
    listed = spark.read.parquet(problem.value.listed).collect()
    assert sorted((r["id"], r["n"]) for r in listed) == [(i, 2) for i in range(50)]


def test_reload_replaces_and_a_refused_file_keeps_the_table(layers, tmp_path):
    files.full_reload(layers, sport_file(tmp_path, "1,Tennis", "2,Judo"), SPORT_FILE, NOW)
    files.full_reload(layers, sport_file(tmp_path, "3,Boxe"), SPORT_FILE, NOW)
    assert [r["id_salarie"] for r in layers.read("raw.sports").collect()] == [3]
    with pytest.raises(InvalidFileError):
        files.full_reload(layers, sport_file(tmp_path, "4,Boxe", "4,Boxe"), SPORT_FILE, NOW)
    assert [r["id_salarie"] for r in layers.read("raw.sports").collect()] == [3]
    log = layers.read_log(audit.RUN_LOG, schemas.PIPELINE_RUNS).orderBy("debut").collect()
    assert [(r["statut"], r["nb_lignes"]) for r in log] == [
        (L.RUN_OK, 2), (L.RUN_OK, 1), (L.RUN_FAILED, None)]
    assert "repeated ids" in log[-1]["message"]


def test_long_failure_messages_are_cut(layers):
    def fail():
        raise RuntimeError("x" * 2000)

    with pytest.raises(RuntimeError):
        audit.logged_step(layers, "essai", fail)
    message = layers.read_log(audit.RUN_LOG, schemas.PIPELINE_RUNS).first()["message"]
    assert len(message) == audit.MESSAGE_LENGTH


def test_failed_write_keeps_the_table(spark, layers):
    layers.reload("raw.t", spark.range(3))
    broken = spark.range(5).select(F.when(F.col("id") > 3, F.raise_error("no")).otherwise(
        F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="no"):
        layers.reload("raw.t", broken)
    assert layers.read("raw.t").count() == 3
    layers.reload("raw.t", spark.range(4))
    assert layers.read("raw.t").count() == 4


def test_unknown_table(layers):
    with pytest.raises(KeyError):
        layers.read("raw.absent")
    assert layers.read_or_empty("raw.absent", schemas.RAW_SPORTS).count() == 0


def test_names_directory(spark, tables):
    names = files.names_directory(tables.salaries)
    assert names.columns == ["id_salarie", "prenom", "nom"]
    assert names.orderBy("id_salarie").first()["prenom"] == "P0"


def test_seeds(spark, tmp_path):
    assert seeds.speed_limits(spark).count() == 7
    path = write(tmp_path / "v.csv", "type_activite,vitesse_max_kmh", "Vélo,62.5")
    assert float(seeds.speed_limits(spark, path).first()["vitesse_max_kmh"]) == 62.5
    path = write(tmp_path / "c.csv", ",".join(schemas.TOWNS.fieldNames()),
                 "Ambérieu,01,Ambérieu,01004,45.9,5.3,01500|01502")
    row = seeds.towns(spark, path).first()
    assert (row["departement"], row["code_insee"], row["codes_postaux"]) == (
        "01", "01004", "01500|01502")
    path = write(tmp_path / "p.csv", ",".join(L.DEFAULT_PARAMS), "0.03,15,25,5,15,218,365")
    assert float(seeds.parameters(spark, path).first()["taux_prime"]) == 0.03
