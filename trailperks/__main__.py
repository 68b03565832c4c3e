"""Command line: ``spark-submit`` or ``python -m trailperks <command> --root <folder> …``.

The exit code is 1 when a gate, a model test or a file check refuses the run.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from trailperks import schemas
from trailperks.operators import distances
from trailperks.operators.joins import count_by
from trailperks.operators.quality import QualityGateError
from trailperks.params import Params
from trailperks.plans.pipeline import CHECKS, DISTANCES, SPEED_LIMITS, TRIPS, Pipeline
from trailperks.session import configure, new_run_folder
from trailperks.sources import seeds
from trailperks.sources.layers import Layers
from trailperks.sources.reference_files import InvalidFileError, names_directory
from trailperks.streaming import announcer, loader, sources
from trailperks.streaming.batches import start_batches


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="trailperks", description="Employee sport benefits")
    top.add_argument("--root", required=True, help="folder of the layer tables")
    top.add_argument("--shuffle-bytes", type=int, help="size of the largest shuffle to expect")
    top.add_argument("--as-of", type=datetime.fromisoformat, help="run time, default now (UTC)")
    commands = top.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="reload the two reference files")
    ingest.add_argument("--hr", required=True)
    ingest.add_argument("--sports", required=True)
    ingest.add_argument("--format", default="csv")

    seed = commands.add_parser("seed", help="reload parameters and speed limits")
    seed.add_argument("--parameters")
    seed.add_argument("--speed-limits")
    seed.add_argument("--towns", help="cache of town centres")

    ask = commands.add_parser("request-distances", help="write the lots to ask the service for")
    ask.add_argument("--out", required=True, help="folder for JSON lines: mode_api, lot, origines")
    ask.add_argument("--force", action="store_true", help="ask again for known distances")

    store = commands.add_parser("store-distances", help="store the answers of the service")
    store.add_argument("--answers", required=True,
                       help="folder of JSON lines: mode_api, lot, reponse (the JSON text)")

    check = commands.add_parser("check", help="run the quality checks")
    check.add_argument("--layers", nargs="+", default=["raw", "geo", "analytics"])
    check.add_argument("--details", action="store_true", help="show passed checks too")

    build = commands.add_parser("build", help="compute the marts and test them")
    build.add_argument("--set", nargs="*", default=[], metavar="NAME=VALUE")
    build.add_argument("--full-refresh", action="store_true", help="empty the history first")

    commands.add_parser("compact", help="fold the change journal into a snapshot")

    for name, text in (("load", "load the change stream"), ("announce", "write announcements")):
        stream = commands.add_parser(name, help=text)
        stream.add_argument("--checkpoint", required=True)
        stream.add_argument("--files", help="folder of JSON lines instead of a topic")
        stream.add_argument("--log", help="folder of JSON-lines segments with positions, like a topic")
        stream.add_argument("--servers")
        stream.add_argument("--topic")
        stream.add_argument("--interval", help="keep running, e.g. '5 seconds'")
        stream.add_argument("--batch-size", type=int,
                            help="most messages (of a topic or log) or files of one batch")
        if name == "announce":
            stream.add_argument("--once", metavar="SPAN", help="announce an activity once in, e.g., "
                                "'24 hours', and none that is older")
            stream.add_argument("--dry-run", action="store_true", help="show texts, write nothing")
    return top


def overrides(pairs: list[str]) -> Params:
    """Parameters from ``NAME=VALUE``; an empty value keeps the default."""
    given = dict(pair.split("=", 1) for pair in pairs)
    return Params().with_overrides(**{name: value or None for name, value in given.items()})


def stream_of(
    spark: SparkSession, options: argparse.Namespace, from_start: bool, checkpoint: str | None = None
) -> DataFrame:
    if options.log:
        return sources.from_log(
            spark, options.log, checkpoint or options.checkpoint, from_start, options.batch_size
        )
    if options.files:
        return sources.from_files(spark, options.files, options.batch_size)
    return sources.from_kafka(
        spark, options.servers, options.topic, from_start, options.batch_size
    )


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    options = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("trailperks").getOrCreate()
    configure(spark, options.shuffle_bytes)
    layers = Layers(spark, options.root)
    as_of = options.as_of or datetime.now(timezone.utc)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    run = Pipeline(layers, as_of)
    try:
        if options.command == "ingest":
            run.ingest(options.hr, options.sports, options.format)
        elif options.command == "seed":
            run.load_seeds(options.parameters, options.speed_limits, options.towns)
        elif options.command == "request-distances":
            run.force_distances = options.force
            print(run.request_distances(), "trips")
            distances.requests(layers.read(TRIPS)).write.mode("overwrite").json(options.out)
        elif options.command == "store-distances":
            run.store_distances(spark.read.schema(schemas.ROUTE_ANSWER).json(options.answers))
            show_distances(layers)
        elif options.command == "check":
            try:
                run.check(*options.layers)
            finally:
                show_checks(layers, run, options.details)
        elif options.command == "build":
            run.params = overrides(options.set) if options.set else None
            run.build(options.full_refresh)
        elif options.command == "compact":
            run.snapshot_activities()
        elif options.command == "load":
            messages = stream_of(spark, options, from_start=True)
            loader.start_loader(
                layers, messages, options.checkpoint, options.interval, bool(options.log)
            ).awaitTermination()
        elif options.command == "announce":
            announce(layers, options)
    except (QualityGateError, InvalidFileError) as refusal:
        print(refusal, file=sys.stderr)
        return 1
    return 0


def show_checks(layers: Layers, run: Pipeline, details: bool) -> None:
    """Print the outcomes of this run; there is one row per check."""
    rows = layers.read_log(CHECKS, schemas.QUALITY_CHECKS).where(f"execution_id = '{run.check_id}'")
    if not details:
        rows = rows.where("resultat <> 'pass'")
    for row in rows.orderBy("fichier_controle", "table_verifiee", "controle").collect():
        print(row["resultat"], row["table_verifiee"], row["controle"], row["valeur"], sep=" | ")


def show_distances(layers: Layers) -> None:
    """Print the number of stored distances per status, and all suspicious ones, longest first."""
    stored = layers.read(DISTANCES)
    for row in count_by(stored, "statut").orderBy("statut").collect():
        print(*row, sep=" | ")
    print_all(distances.suspects_preview(stored))


def print_all(rows: DataFrame) -> None:
    """Every row, fetched from one partition after the other."""
    for row in rows.toLocalIterator():
        print(*row, sep=" | ")


def announce(layers: Layers, options: argparse.Namespace) -> None:
    if layers.version(SPEED_LIMITS) is None:
        limits = seeds.speed_limits(layers.spark)
    else:
        limits = layers.read(SPEED_LIMITS)
    if options.dry_run:
        dry_run(layers, options, limits)
        return
    messages = stream_of(layers.spark, options, from_start=False)
    announcer.start_announcer(
        layers, messages, options.checkpoint, limits, options.interval, options.once, bool(options.log)
    ).awaitTermination()
    announcer.settle(layers.spark)


def dry_run(layers: Layers, options: argparse.Namespace, limits: DataFrame) -> None:
    """Print the texts of the stream, from whichever source; the announcer's own checkpoint stays as it is."""
    names = names_directory(layers.read_or_empty(announcer.SALARIES, schemas.RAW_SALARIES))
    checkpoint = new_run_folder(layers.spark, "dry-run")
    messages = stream_of(layers.spark, options, from_start=False, checkpoint=checkpoint)
    start_batches(
        messages, checkpoint, lambda batch, _: print_all(announcer.preview(batch, limits, names)),
        options.interval, bool(options.log),
    ).awaitTermination()


if __name__ == "__main__":
    sys.exit(main())
