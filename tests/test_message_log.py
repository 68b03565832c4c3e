"""The log of segments as a streaming source, and the queries that run over it."""

import io
import json

import pytest
from pyspark.errors import StreamingQueryException
from test_stream import event, state

from trailperks import schemas
from trailperks.catalog import flows
from trailperks.sources import reference_files as files, seeds
from trailperks.sources.layers import Layers
from trailperks.streaming import announcer, loader, message_log, sources
from trailperks.streaming.message_log import LogReader


def line(offset, value, partition=0):
    return json.dumps({"partition": partition, "offset": offset, "value": value}) + "\n"


def segment(folder, name, *entries, end=""):
    folder.mkdir(exist_ok=True)
    text = "".join(line(offset, value) for offset, value in entries) + end
    (folder / name).write_text(text, encoding="utf-8")


def reader(folder, **options):
    return LogReader({"path": str(folder)} | {name.lower(): str(value) for name, value in options.items()})


def offsets(source, start, end):
    pieces = source.partitions(start, end)
    return [v for piece in pieces for batch in source.read(piece) for v in batch.column("offset").to_pylist()]


START = {"file": "", "bytes": 0}


@pytest.mark.parametrize("task, block", [(1, 3), (7, 5), (50, 1000), (2**20, 2**16)])
def test_every_line_once_whatever_the_ranges(tmp_path, monkeypatch, task, block):
    monkeypatch.setattr(message_log, "TASK_BYTES", task)
    monkeypatch.setattr(message_log, "BLOCK", block)
    segment(tmp_path / "log", "0", *[(n, "x" * (n * 7 % 40)) for n in range(30)])
    segment(tmp_path / "log", "1")
    segment(tmp_path / "log", "2", (30, "é" * 30), (31, None), end='{"partition": 0, "off')
    source = reader(tmp_path / "log")
    assert offsets(source, START, source.latestOffset()) == list(range(32))
    middle = {"file": "0", "bytes": sum(len(line(n, "x" * (n * 7 % 40))) for n in range(12))}
    assert offsets(source, middle, source.latestOffset()) == list(range(12, 32))


def test_batches_of_so_many_messages(tmp_path):
    segment(tmp_path / "log", "0", *[(n, "a") for n in range(7)])
    segment(tmp_path / "log", "1", *[(n, "b") for n in range(7, 12)], end="unfinished")
    source = reader(tmp_path / "log", messagesPerBatch=3)
    at, sizes = source.initialOffset(), []
    while (end := source.latestOffset()) != at:
        sizes.append(len(offsets(source, at, end)))
        at = end
    assert sizes == [3, 3, 3, 3]
    segment(tmp_path / "log", "2", (12, "c"))
    # What is unfinished when the log goes on in a new file is a bad message.
    assert offsets(source, at, source.latestOffset()) == [None, 12]


def test_a_query_that_goes_on_tells_its_position(tmp_path):
    """Spark asks a new reader for the empty range at the last position before anything else."""
    segment(tmp_path / "log", "0", *[(n, "a") for n in range(10)])
    first = reader(tmp_path / "log", messagesPerBatch=4)
    first.initialOffset()
    position = first.latestOffset()
    second = reader(tmp_path / "log", messagesPerBatch=4)
    assert second.partitions(position, position) == []
    assert offsets(second, position, second.latestOffset()) == [4, 5, 6, 7]


def test_from_now_on_is_kept(tmp_path):
    segment(tmp_path / "log", "0", (0, "old"))
    options = {"start": "latest", "startFile": tmp_path / "c.start.json"}
    first = reader(tmp_path / "log", **options).initialOffset()
    segment(tmp_path / "log", "1", (1, "new"))
    again = reader(tmp_path / "log", **options)
    assert again.initialOffset() == first and offsets(again, first, again.latestOffset()) == [1]
    limited = reader(tmp_path / "log", messagesPerBatch=5, **options)
    assert offsets(limited, first, limited.latestOffset()) == [1]
    with pytest.raises(ValueError):
        reader(tmp_path / "log", start="latest")


def test_only_complete_segments(tmp_path):
    log = tmp_path / "log"
    source = reader(log)
    assert source.latestOffset() == START
    segment(log, "0", (0, "a"))
    (log / "1").mkdir()
    segment(log / "1", "part-0", (1, "b"))
    segment(log, "_hidden", (9, "z"))
    assert offsets(source, START, source.latestOffset()) == [0]
    (log / "1" / "_SUCCESS").write_text("")
    assert offsets(source, START, source.latestOffset()) == [0, 1]


def test_lines_that_are_no_messages(tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    (log / "0").write_text('{broken\n[1]\n\n{"partition": "x", "offset": 1}\n' + line(5, "ok"), encoding="utf-8")
    source = reader(log)
    rows = [r for p in source.partitions(START, source.latestOffset()) for b in source.read(p) for r in b.to_pylist()]
    assert [(r["offset"], r["value"]) for r in rows] == [
        (None, "{broken"), (None, "[1]"), (None, '{"partition": "x", "offset": 1}'), (5, "ok")]


def test_loader_and_announcer_start_at_different_places(layers, tmp_path):
    """One log that grows between batches: the loader reads all of it, the announcer what is new."""
    spark, log = layers.spark, tmp_path / "log"
    segment(log, "0", *[(n, event(id_activite=n)) for n in range(5)])
    limits = seeds.speed_limits(spark)

    def start():
        loading = sources.from_log(spark, str(log), str(tmp_path / "loader"), True, 2)
        telling = sources.from_log(spark, str(log), str(tmp_path / "teller"), False, 2)
        return (
            loader.start_loader(layers, loading, str(tmp_path / "loader"), drain=True),
            announcer.start_announcer(layers, telling, str(tmp_path / "teller"), limits, drain=True),
        )

    for query in start():
        query.awaitTermination()
    assert state(layers) == {n: 10800 for n in range(5)} and announcer.outbox(layers).count() == 0
    segment(log, "1", *[(n, event(id_activite=n)) for n in range(5, 8)], (8, event(id_activite=1, distance_m=7, __op="u")))
    for query in start():
        query.awaitTermination()
    assert state(layers) == {n: 7 if n == 1 else 10800 for n in range(8)}
    assert sorted(r["id_activite"] for r in announcer.outbox(layers).collect()) == [5, 6, 7]
    sizes = [r["nb_lignes"] for r in loader.load_log(layers).collect()]
    assert sum(sizes) == 9 and max(sizes) == 2
    counted = announcer.counters(layers).collect()
    assert sorted((r["publies"], r["ignores"]) for r in counted if r["publies"] + r["ignores"]) == [(1, 1), (2, 0)]


def test_a_first_batch_that_fails_starts_at_the_same_place(layers, tmp_path, monkeypatch):
    spark, log = layers.spark, tmp_path / "log"
    segment(log, "0", (0, event(id_activite=0)))

    def announce():
        stream = sources.from_log(spark, str(log), str(tmp_path / "c"), from_start=False)
        announcer.start_announcer(
            layers, stream, str(tmp_path / "c"), seeds.speed_limits(spark), drain=True
        ).awaitTermination()

    announce()
    segment(log, "1", (1, event(id_activite=1)))
    with monkeypatch.context() as patched:
        patched.setattr(announcer, "announced_texts", lambda *_: 1 / 0)
        with pytest.raises(StreamingQueryException):
            announce()
    segment(log, "2", (2, event(id_activite=2)))
    announce()
    assert sorted(r["id_activite"] for r in announcer.outbox(layers).collect()) == [1, 2]


def captured(number, hour):
    return event(id_activite=number, __source_ts_ms=1_782_890_220_000 + hour * 3_600_000)


def test_announced_once_and_not_too_late(layers, tmp_path):
    """Repeats in a batch, in a later one and after a restart; state holds the ids of two spans at most."""
    spark, log = layers.spark, tmp_path / "log"
    rows = {}

    def announce():
        stream = sources.from_log(spark, str(log), str(tmp_path / "c"))
        query = announcer.start_announcer(
            layers, stream, str(tmp_path / "c"), seeds.speed_limits(spark), once="24 hours"
        )
        query.awaitTermination()
        rows["state"] = query.lastProgress.stateOperators[0].numRowsTotal
        return sorted(r["id_activite"] for r in announcer.outbox(layers).collect())

    segment(log, "0", (0, captured(1, 0)), (1, captured(1, 0)), (2, captured(2, 10)))
    assert announce() == [1, 2]
    segment(log, "1", (3, captured(1, 0)), (4, captured(2, 10)), (5, captured(3, 50)))
    assert announce() == [1, 2, 3] and rows["state"] == 2  # the id of hour 0 has left
    segment(log, "2", (6, captured(1, 0)), (7, captured(4, 2)), (8, captured(5, 40)), (9, captured(3, 50)))
    assert announce() == [1, 2, 3, 5]
    segment(log, "3", (10, captured(6, 500)))
    assert announce() == [1, 2, 3, 5, 6] and rows["state"] == 1


def test_names_are_looked_up_by_range(spark, tmp_path):
    """A batch reads the folders of its ids, not the whole names table."""
    layers = Layers(spark, str(tmp_path / "layers"))
    people = spark.range(0, 40 * files.ID_RANGE, 100).selectExpr(
        "CAST(id AS INT) id_salarie", "concat('N', id) nom", "'P ' prenom", "CAST(NULL AS DATE) date_naissance",
        "'' bu", "CAST(NULL AS DATE) date_embauche", "1 salaire_brut", "'CDI' type_contrat", "1 jours_cp", "'' adresse",
        "'' moyen_deplacement", "'f' fichier_source", "timestamp_seconds(0) charge_le",
    )
    layers.reload(files.SALARIES, people)
    files.store_names(layers)
    ids = [5 * files.ID_RANGE + 100 * n for n in range(250)] + [7, None, 10**9]
    batch = spark.createDataFrame([(n,) for n in ids], "id_salarie int")
    names = announcer.names_of(layers, batch)
    everything = layers.read(files.NAMES)
    assert len(everything.inputFiles()) >= 40
    read = {path.split("tranche=")[1].split("/")[0] for path in _read_files(names)}
    assert read == {"0", "5", "6", "7"}
    found = {r["id_salarie"]: r["nom"] for r in batch.join(names, "id_salarie").collect()}
    assert found == {n: f"N{n}" for n in ids[:250]}


def _read_files(frame):
    from pyspark.sql import functions as F

    return [r[0] for r in frame.select(F.input_file_name()).distinct().collect()]


def test_new_names_are_known_at_once_and_none_before_the_first(layers, tmp_path):
    spark = layers.spark
    rows = spark.createDataFrame([(1, event())], "offset long, value string").selectExpr("0 partition", "offset", "value")

    def text(name):
        announcer.announce_batch(layers, announcer.new_activities(rows, seeds.speed_limits(spark)), name)
        return layers.read_batches(announcer.OUTBOX, announcer.OUTBOX_SCHEMA, [name]).first()["texte"]

    def ingest(*people):
        known = [(number, last, first, *[None] * 8, "f", None) for number, last, first in people]
        layers.reload(files.SALARIES, spark.createDataFrame(known, schemas.RAW_SALARIES))
        files.store_names(layers)

    assert "Un collègue" in text("a")
    ingest((1, "Mendes", "Juliette"))
    assert "Un collègue" in text("b")
    ingest((1, "Mendes", "Juliette"), (7, "Durand", "Paul"))
    assert "Paul Durand" in text("c")


def test_the_number_of_batches_does_not_grow_with_the_table(tables, tmp_path, monkeypatch):
    """Small batches over a table of many: the reader still ends after a few."""
    monkeypatch.setattr(flows, "new_run_folder", lambda spark, purpose: str(tmp_path / purpose))
    monkeypatch.setattr(flows, "BATCH_MESSAGES", 50)
    monkeypatch.setattr(flows, "BATCHES", 4, raising=False)
    rows = flows.stream_two_starts(tables)
    messages = tables.activities.count()
    assert messages > 12 * 50
    assert rows.where("flux = 'chargement'").select("id_activite").distinct().count() == messages
    commits = [path.name for path in (tmp_path / "two-starts" / "loader" / "commits").iterdir()]
    assert len([name for name in commits if name.isdigit()]) <= 6


def test_the_end_of_so_many_lines(monkeypatch):
    data = b"a\n\nbb\n" + b"c" * 20 + b"\n\n\nd\nopen"
    ends = [n + 1 for n in range(len(data)) if data[n : n + 1] == b"\n"]
    for block in (1, 2, 5, 100):
        monkeypatch.setattr(message_log, "BLOCK", block)
        for begin in range(len(data)):
            behind = [end for end in ends if end > begin]
            for count in range(1, 9):
                taken = behind[:count]
                found = message_log.after_lines(io.BytesIO(data), begin, len(data), count)
                assert found == (taken[-1] if taken else begin, len(taken))
