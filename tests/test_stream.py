"""Change stream: parsing, last writer wins, replays, quarantine, announcements."""

import json
from contextlib import redirect_stdout
from datetime import datetime, timezone
from io import StringIO

import pytest

from trailperks import labels as L, schemas
from trailperks.operators import changes
from trailperks.sources import seeds
from trailperks.streaming import announcer, loader, sources

EVENT = {
    "id_activite": 42, "id_salarie": 7, "date_debut": "2026-07-01T06:30:00.123456Z",
    "date_fin": "2026-07-01T07:16:00.123456Z", "type_activite": "Course à pied",
    "distance_m": 10800, "commentaire": None, "source": "live",
    "cree_le": "2026-07-01T07:17:00Z", "__op": "c", "__source_ts_ms": 1782890220000,
}


def event(**changed):
    return json.dumps(EVENT | changed)


def messages(spark, *values, partition=0):
    rows = [(partition, offset, value) for offset, value in enumerate(values)]
    return spark.createDataFrame(rows, schemas.CHANGE_MESSAGE)


def parsed(spark, *values):
    return changes.accepted(changes.parse(messages(spark, *values)))


def text_of(spark, *values, names=((7, "Anne", "Dupont"),)):
    directory = spark.createDataFrame(list(names), "id_salarie int, prenom string, nom string")
    shown = announcer.preview(messages(spark, *values), seeds.speed_limits(spark), directory)
    return [row["texte"] for row in shown.orderBy("id_activite").collect()]


def test_full_event(spark):
    row = parsed(spark, event()).first()
    assert row["date_debut"].replace(tzinfo=None).microsecond == 123456
    assert row["operation"] == "c" and row["id_salarie"] == 7
    seconds = parsed(spark, event()).selectExpr("unix_millis(capture_le) AS ms").first()["ms"]
    assert seconds == EVENT["__source_ts_ms"]


def test_permissive_values(spark):
    rows = parsed(spark, event(distance_m=-5), event(distance_m=None), None, '{"id_activite": 3}',
                  event(__source_ts_ms=0))
    by_offset = {r["offset"]: r for r in rows.collect()}
    assert sorted(by_offset) == [0, 1, 3, 4]
    assert by_offset[0]["distance_m"] == -5 and by_offset[1]["distance_m"] is None
    assert by_offset[3]["date_debut"] is None and by_offset[4]["capture_le"] is None


@pytest.mark.parametrize("value", [
    "{not json", '{"id_salarie": 7}', event(date_debut="yesterday"), event(distance_m="far"), "[]",
])
def test_bad_messages_are_quarantined(spark, value):
    frame = changes.parse(messages(spark, value, event()))
    assert changes.accepted(frame).count() == 1
    assert [r["rejet"] for r in changes.rejected(frame).collect()] == [value]


def test_last_change_wins(spark):
    rows = parsed(spark, event(distance_m=1), event(distance_m=2), event(id_activite=1),
                  event(distance_m=3))
    latest = {r["id_activite"]: r["distance_m"] for r in changes.latest_per_activity(rows).collect()}
    assert latest == {42: 3, 1: 10800}


def lines(folder, name, *entries):
    folder.mkdir(exist_ok=True)
    text = "\n".join(
        json.dumps({"partition": 0, "offset": offset, "value": value}) for offset, value in entries
    )
    (folder / name).write_text(text + "\n", encoding="utf-8")


def load(layers, tmp_path, checkpoint="checkpoint", files_per_batch=1):
    stream = sources.from_files(layers.spark, str(tmp_path / "topic"), files_per_batch)
    loader.start_loader(layers, stream, str(tmp_path / checkpoint)).awaitTermination()


def state(layers):
    return {r["id_activite"]: r["distance_m"] for r in loader.current_activities(layers).collect()}


def test_loader_upserts_over_batches(layers, tmp_path):
    lines(tmp_path / "topic", "1.json", (0, event(id_activite=1)), (1, event(id_activite=2)))
    load(layers, tmp_path)
    assert state(layers) == {1: 10800, 2: 10800}
    lines(tmp_path / "topic", "2.json", (2, event(id_activite=2, distance_m=5, __op="u")),
          (3, None), (4, "{broken"), (5, event(id_activite=3)))
    load(layers, tmp_path)
    assert state(layers) == {1: 10800, 2: 5, 3: 10800}
    log = loader.load_log(layers).orderBy("debut").collect()
    assert [(r["statut"], r["nb_lignes"]) for r in log] == [(L.RUN_OK, 2), (L.RUN_OK, 2)]
    assert [r["rejet"] for r in loader.rejected_messages(layers).collect()] == ["{broken"]


def test_replay_of_a_batch_changes_nothing(layers, tmp_path):
    """A batch whose commit was lost after its write runs again with the same number."""
    for number in range(3):
        lines(tmp_path / "topic", f"{number}.json",
              *[(number * 10 + i, event(id_activite=i, distance_m=number)) for i in range(4)])
    load(layers, tmp_path)
    before = state(layers)
    rows = loader.journal(layers).count()
    commits = tmp_path / "checkpoint" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for lost in (commits / str(last), commits / f".{last}.crc"):
        if lost.exists():
            lost.unlink()
    load(layers, tmp_path)
    assert state(layers) == before == {i: 2 for i in range(4)}
    assert loader.journal(layers).count() == rows


def test_failing_batch_is_not_committed(layers, tmp_path, monkeypatch):
    lines(tmp_path / "topic", "1.json", (0, event(id_activite=1)))

    def fail(*_):
        raise RuntimeError("storage lost")

    with monkeypatch.context() as patched:
        patched.setattr(loader, "load_batch", fail)
        with pytest.raises(Exception, match="storage lost"):
            load(layers, tmp_path)
    load(layers, tmp_path)
    assert state(layers) == {1: 10800}


def test_compaction_keeps_the_state(layers, tmp_path):
    lines(tmp_path / "topic", "1.json", (0, event(id_activite=1)), (1, event(id_activite=2)))
    load(layers, tmp_path)
    loader.compact(layers)
    assert state(layers) == {1: 10800, 2: 10800}
    lines(tmp_path / "topic", "2.json", (2, event(id_activite=1, distance_m=9)))
    load(layers, tmp_path)
    assert state(layers) == {1: 9, 2: 10800}
    loader.compact(layers)
    assert state(layers) == {1: 9, 2: 10800}
    loader.compact(layers)
    assert layers.version(loader.ACTIVITIES) == 2
    loader.compact(layers, recluster=True)
    assert layers.version(loader.ACTIVITIES) == 3 and state(layers) == {1: 9, 2: 10800}


@pytest.mark.parametrize("folds", [(), (0,), (0, 1), (1,), (0, 1, 2)])
def test_new_checkpoints_lose_nothing(layers, tmp_path, folds):
    """Three checkpoints over one topic, with folds between them; the last offset of an id wins."""
    expected = {}
    for number, entries in enumerate([[(5, 1, 50), (9, 2, 90)], [(1, 1, 10), (2, 3, 20)], [(7, 1, 70), (8, 3, 80)]]):
        lines(tmp_path / "topic", f"{number}.json",
              *[(offset, event(id_activite=i, distance_m=d)) for offset, i, d in entries])
        for offset, i, d in entries:
            expected[i] = max(expected.get(i, (-1, None)), (offset, d))
        load(layers, tmp_path, checkpoint=f"checkpoint-{number}")
        if number in folds:
            loader.compact(layers)
        assert state(layers) == {i: d for i, (_, d) in expected.items()}


def test_folds_expire_batches_and_keep_bad_messages(layers, tmp_path):
    for number in range(4):
        lines(tmp_path / "topic", f"{number}.json",
              (2 * number, event(id_activite=number)), (2 * number + 1, "{broken"))
        load(layers, tmp_path)
        loader.compact(layers)
    assert loader.journal(layers).select("batch").distinct().count() == 1
    assert loader.rejected_messages(layers).count() == 4 and len(state(layers)) == 4
    folders = [p.name for p in (tmp_path / "layers" / "raw" / "activites").iterdir()]
    assert sum(name.startswith("v-") for name in folders) == 2


def test_outbox_of_an_earlier_checkpoint_stays(layers, tmp_path):
    limits = seeds.speed_limits(layers.spark)
    for number in range(2):
        lines(tmp_path / f"topic-{number}", "1.json", (number, event(id_activite=number)))
        stream = sources.from_files(layers.spark, str(tmp_path / f"topic-{number}"))
        announcer.start_announcer(layers, stream, str(tmp_path / f"c-{number}"), limits).awaitTermination()
    assert sorted(r["id_activite"] for r in announcer.outbox(layers).collect()) == [0, 1]


def test_fold_does_not_shuffle_the_snapshot(layers, tmp_path):
    lines(tmp_path / "topic", "1.json", *[(i, event(id_activite=i)) for i in range(50)])
    load(layers, tmp_path)
    loader.compact(layers)
    lines(tmp_path / "topic", "2.json", (90, event(id_activite=1, distance_m=9)))
    load(layers, tmp_path)
    unchanged, newest = loader._parts(layers, loader.open_batches(layers))
    assert unchanged.count() == 49 and newest.count() == 1
    unchanged.collect()
    out = StringIO()
    with redirect_stdout(out):
        unchanged.explain()
    final = out.getvalue().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "LeftAnti" in final and "SortMergeJoin" not in final


def test_announcement_texts(spark):
    assert text_of(spark, event()) == [
        "Bravo Anne Dupont ! Tu viens de courir 10,8 km en 46 min ! Quelle énergie !"
        " — 14,1 km/h de moyenne"]
    assert text_of(spark, event(commentaire="Top"))[0].endswith(' ("Top")')
    assert text_of(spark, event(commentaire=""))[0].endswith("de moyenne")
    climbing = event(type_activite="Escalade", distance_m=None)
    assert text_of(spark, climbing) == ["Bravo Anne Dupont ! 46 min d'escalade, quelle séance !"]
    assert "46 min de tennis" in text_of(spark, event(type_activite="Tennis", distance_m=0))[0]
    other = event(type_activite="Tennis", distance_m=800)
    assert "800 m de tennis en 46 min" in text_of(spark, other)[0]
    assert text_of(spark, event(id_salarie=99))[0].startswith("Bravo Un collègue !")
    odd = text_of(spark, event(), names=((7, "{distance}", "X"),))[0]
    assert odd.startswith("Bravo {distance} X !")


@pytest.mark.parametrize("changed", [
    {"source": "backfill"}, {"__op": "r"}, {"__op": "u"}, {"distance_m": -10800},
    {"distance_m": 1080000},
    {"date_debut": EVENT["date_fin"], "date_fin": EVENT["date_debut"]},
    {"type_activite": "Natation", "distance_m": 172400, "date_fin": "2026-07-01T07:03:00.123456Z"},
])
def test_not_announced(spark, changed):
    assert text_of(spark, event(**changed)) == []


def test_announced_sources(spark):
    ride = event(id_activite=1, type_activite="Vélo", distance_m=65900, source="strava",
                 date_fin="2026-07-01T09:00:00.123456Z")
    assert len(text_of(spark, ride, None)) == 1


def test_announcer_runs_beside_the_loader(layers, tmp_path):
    """Two queries over the same messages with their own positions; names appear when ingested."""
    lines(tmp_path / "topic", "1.json", (0, event(id_activite=1)), (1, event(source="backfill")))
    load(layers, tmp_path)
    limits = seeds.speed_limits(layers.spark)

    def announce():
        stream = sources.from_files(layers.spark, str(tmp_path / "topic"))
        query = announcer.start_announcer(layers, stream, str(tmp_path / "announced"), limits)
        query.awaitTermination()
        texts = {r["id_activite"]: r["texte"] for r in announcer.outbox(layers).collect()}
        counted = announcer.counters(layers).collect()
        return texts, sorted((r["publies"], r["ignores"]) for r in counted)

    texts, counted = announce()
    assert texts[1].startswith("Bravo Un collègue !") and counted == [(1, 1)]
    now = datetime(2026, 7, 1, tzinfo=timezone.utc)
    person = (7, "Dupont ", " Anne", None, None, None, None, None, None, None, None, "f", now)
    layers.reload(
        announcer.SALARIES, layers.spark.createDataFrame([person], schemas.RAW_SALARIES)
    )
    lines(tmp_path / "topic", "2.json", (2, event(id_activite=3)), (3, None), (4, "{broken"))
    texts, counted = announce()
    assert texts[3].startswith("Bravo Anne Dupont !") and sorted(texts) == [1, 3]
    assert counted == [(1, 1), (1, 2)]


def test_batch_without_announcement(layers, spark):
    """Nothing to announce, with a names table that has to be shuffled."""
    now = datetime(2026, 7, 1, tzinfo=timezone.utc)
    rows = [(i, "a", "b", *[None] * 8, "f", now) for i in range(50)]
    layers.reload(announcer.SALARIES, spark.createDataFrame(rows, schemas.RAW_SALARIES))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        quiet = messages(spark, *[event(source="backfill")] * 20)
        for number, rows in enumerate((quiet, quiet.limit(0))):
            new = announcer.new_activities(rows, seeds.speed_limits(spark))
            announcer.announce_batch(layers, new, f"q-{number}")
        loader.load_batch(layers, quiet.limit(0), "q-0")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert announcer.outbox(layers).count() == 0
    assert loader.current_activities(layers).count() == 0
