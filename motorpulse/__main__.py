"""Run the jobs: ``python -m motorpulse dims|run --help``, or the same under spark-submit."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from .operators.dimensions import load_profile, preview, write_fixed_dimensions
from .operators.enrich import LOOKUPS
from .operators.fleet_store import KEYS, PROFILE, FleetStore
from .schemas import (
    ALERT_TOPIC,
    CARS,
    COUNTER_TOPICS,
    ENRICHED_TOPIC,
    RAW_TOPIC,
    REFRESH_EVERY,
)
from .session import kafka_package, object_store_settings, session, state_store_settings
from .sources.messages import FileTopic, FileTopics, KafkaTopic, split_topics
from .streaming import STEPS, SnapshotTable, drain, fleet_steps, start, wait_for_any
from .streaming.jobs import MODES, STRAY_AFTER


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="motorpulse", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    dims = commands.add_parser("dims", help="write the model and color tables, and publish cars")
    dims.add_argument("--dims", required=True, help="folder of the dimension tables")
    cars = dims.add_mutually_exclusive_group()
    cars.add_argument("--cars", help="publish a version with these cars (.csv, .json or Parquet)")
    cars.add_argument("--add-cars", help="publish a version with these cars beside those stored")
    dims.add_argument("--buckets", type=int, default=32, help="files of the car profile")

    run = commands.add_parser("run", help="run the streaming jobs")
    topics = run.add_mutually_exclusive_group(required=True)
    topics.add_argument("--servers", help="Kafka bootstrap servers")
    topics.add_argument("--files", help="folder with one directory per topic")
    run.add_argument("--dims", required=True, help="folder of cars, car_models, car_colors")
    run.add_argument("--store", required=True, help="folder for checkpoints and results")
    run.add_argument("--raw", default=RAW_TOPIC)
    run.add_argument("--enriched", default=ENRICHED_TOPIC)
    run.add_argument("--alerts", default=ALERT_TOPIC)
    run.add_argument("--counted", default=COUNTER_TOPICS, help="topics the counter reads")
    run.add_argument("--starting", default="latest", help="where to start in the raw topic")
    run.add_argument("--per-trigger", help="most messages, or files, per micro-batch")
    run.add_argument("--from-step", choices=STEPS)
    run.add_argument("--drain", action="store_true", help="one step after the other, then end")
    run.add_argument("--refresh", action="store_true", help="read dimensions per micro-batch")
    run.add_argument(
        "--mode",
        choices=(*MODES, "panes"),
        default="complete",
        help="output mode of the counts; panes stores counts per minute and keeps no state",
    )
    run.add_argument("--only-latest", action="store_true", help="keep only the latest window")
    run.add_argument("--preview", action="store_true", help="show events and the latest window")
    run.add_argument("--lookup", choices=LOOKUPS, default="auto", help="how cars are looked up")
    run.add_argument("--hot-cars", help="comma-separated ids of cars with very many events")
    run.add_argument("--on-malformed", choices=("keep", "drop"), default="keep")
    run.add_argument("--quarantine", metavar="TOPIC", help="for malformed messages, as text")
    run.add_argument("--once-within", help="drop what is delivered again within this time")
    run.add_argument("--strays", metavar="TOPIC", help="for alerts of times far from their arrival")
    run.add_argument("--stray-after", default=STRAY_AFTER, help="how far that is")
    run.add_argument("--late", metavar="TOPIC", help="for alerts too late for the panes")
    run.add_argument("--every", default=REFRESH_EVERY, help="refresh of the counts")
    for command in (dims, run):
        command.add_argument("--endpoint", help="object store, with the keys of AWS_ACCESS_KEY_ID")
        command.add_argument("--region", default="us-east-1", help="region of the object store")
    args = parser.parse_args(argv)
    if args.command == "run" and args.mode == "panes" and args.only_latest:
        parser.error("--only-latest keeps a window, and --mode panes stores none")
    if args.command == "run" and args.late and args.mode != "panes":
        parser.error("--late needs --mode panes; windows drop late rows, or count all")
    if args.command == "run" and args.servers and args.drain and args.starting == "latest":
        parser.error("--drain from the latest offsets would read nothing; say --starting earliest")
    return args


SIDE_TOPICS = ("quarantine", "strays", "late")


def _topics(args: argparse.Namespace) -> dict:
    counted = split_topics(args.counted)
    names = {"raw": args.raw, "enriched": args.enriched, "alert": args.alerts}
    names |= {k: getattr(args, k) for k in SIDE_TOPICS if getattr(args, k)}
    if args.servers:
        limit = {"maxOffsetsPerTrigger": args.per_trigger} if args.per_trigger else {}
        # What the chain itself writes is read from its beginning, or a step that starts
        # after the one before it would miss that one's first messages.
        own = {"starting": "earliest", "options": limit}
        raw = {"starting": args.starting, "options": limit}
        made = {k: KafkaTopic(args.servers, n, **(raw if k == "raw" else own)) for k, n in names.items()}
        # A pattern takes those of the topics that exist, also if they appear later.
        pattern = "|".join(n.replace(".", r"\.") for n in counted)
        return made | {"counter_input": KafkaTopic(args.servers, pattern, pattern=True, **own)}
    limit = {"maxFilesPerTrigger": args.per_trigger} if args.per_trigger else {}
    make = lambda name: FileTopic(f"{args.files}/{name}", name, options=limit)
    made = {k: make(n) for k, n in names.items()}
    return made | {"counter_input": FileTopics(tuple(make(n) for n in counted))}


def _run(args: argparse.Namespace, spark: SparkSession) -> None:
    paths = [f"{args.dims}/{name}" for name in ("cars", "car_models", "car_colors")]
    store = FleetStore(args.dims)
    published = store.exists(spark)

    def profile(current: SparkSession) -> DataFrame:
        """Of the newest published version, or made of plain tables where none was published."""
        return store.profile(current) if published else load_profile(current, *paths)

    counts_every = {"availableNow": True} if args.drain else {"processingTime": args.every}
    panes = args.mode == "panes"
    topics = _topics(args)
    aside = {k: topics.pop(k, None) for k in SIDE_TOPICS}
    how = {"late": aside["late"]} if panes else {"mode": args.mode, "only_latest": args.only_latest}
    steps = fleet_steps(
        spark,
        **topics,
        table=SnapshotTable(f"{args.store}/{'panes' if panes else f'windows-{args.mode}'}"),
        profile=profile if args.refresh else profile(spark),
        checkpoints=f"{args.store}/checkpoints",
        trigger={"availableNow": True} if args.drain else None,
        counter_trigger=counts_every,
        panes=panes,
        preview=args.preview,
        enrichment={
            "lookup": "salted" if args.hot_cars else args.lookup,
            "hot_keys": [int(c) for c in split_topics(args.hot_cars)] if args.hot_cars else None,
            "on_malformed": args.on_malformed,
            "quarantine": aside["quarantine"],
            "once_within": args.once_within,
        },
        limits={"strays": aside["strays"], "within": args.stray_after},
        **how,
    )
    if args.drain:
        drain(steps, args.from_step)
    else:
        wait_for_any(spark, start(steps, args.from_step))


def _cars(spark: SparkSession, path: str) -> DataFrame:
    kind = next((k for k in ("csv", "json") if path.endswith(f".{k}")), "parquet")
    options = {"header": "true", "mode": "FAILFAST"} if kind == "csv" else {}
    return spark.read.format(kind).schema(CARS).options(**options).load(path)


def _dims(args: argparse.Namespace, spark: SparkSession) -> None:
    if not (args.cars or args.add_cars):
        tables = {"car_models": "model_id", "car_colors": "color_id"}
        write_fixed_dimensions(spark, *[f"{args.dims}/{name}" for name in tables])
        for name, key in tables.items():
            preview(spark.read.parquet(f"{args.dims}/{name}"), key).show(truncate=False)
        return
    brought = {"cars": args.cars} if args.cars else {"new_cars": args.add_cars}
    store = FleetStore(args.dims, args.buckets)
    version = store.publish(spark, **{k: _cars(spark, path) for k, path in brought.items()})
    print(f"version {version.number}")
    preview(version.read(spark, PROFILE), KEYS[PROFILE]).show(truncate=False)


def _store_settings(args: argparse.Namespace) -> dict[str, str]:
    if not args.endpoint:
        return {}
    keys = [os.environ.get(k) for k in ("AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY")]
    return object_store_settings(args.endpoint, *keys, region=args.region)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    settings = _store_settings(args)
    if args.command == "dims":
        _dims(args, session("motorpulse-dims", settings=settings))
        return
    packages = [kafka_package()] if args.servers else []
    _run(args, session("motorpulse", packages=packages, settings=state_store_settings() | settings))


if __name__ == "__main__":
    main()
