"""Command line of the runs, for spark-submit or ``python -m layerloom``.

``--source`` is a JDBC URL, or a folder with one Parquet table per source table. The date is
yesterday unless given.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from layerloom.params import DT_POLICIES, now_text, run_dt
from layerloom.plans import daily
from layerloom.plans.validate import validate
from layerloom.schemas import DWS_SPECS, SOURCE_TABLES
from layerloom.session import build_session
from layerloom.sinks.exports import export_csv, export_summary
from layerloom.sources.field_list import read_configs
from layerloom.sources.relational import database_counts, read_table, source_now
from layerloom.sources.topics import stream_files, stream_topic
from layerloom.streaming.cdc import CdcJob, replay_day, start_configured, start_ingest


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="layerloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="folder of the warehouse")
        return sub

    def source_options(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--source", required=True)
        sub.add_argument("--partitions", type=int, default=16, help="parallel reads per table")
        sub.add_argument("dt", nargs="?")

    run = command("run-day", "import, check, cleanse and aggregate one day")
    source_options(run)
    run.add_argument("--strict-counts", action="store_true")
    run.add_argument("--use-digests", action="store_true")
    run.add_argument("--catalog", help="database in which tables and partitions are registered")
    source_options(command("import-changes", "append the rows changed since the last import"))
    command("validate", "print the row checks of one day").add_argument("dt", nargs="?")
    source_options(command("check", "print the row-count and partition checks of one day"))
    command("backfill", "recompute the metrics of every day")
    export = command("export", "write the metric tables as CSV")
    export.add_argument("--folder", required=True)
    export.add_argument("--since", required=True)
    replay = command("replay", "merge the change log of one day again")
    replay.add_argument("dt", nargs="?")
    ingest = command("ingest", "ingest the change log as a stream")
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--servers", help="brokers; with --topic")
    ingest.add_argument("--topic")
    ingest.add_argument("--files", help="folder of event files instead of a topic")
    ingest.add_argument("--once", action="store_true", help="stop after the available events")
    ingest.add_argument("--dt-policy", choices=DT_POLICIES, default="business_date")
    ingest.add_argument("--append-only", action="store_true", help="merge later, with replay")
    ingest.add_argument("--rate", type=int, help="most events (topic) or files of one batch")
    ingest.add_argument("--configs", help="file of configuration lines: only append the tables they name")
    return parser


def _sources(spark: SparkSession, source: str, partitions: int) -> dict[str, DataFrame]:
    if source.startswith("jdbc:"):
        return {name: read_table(spark, source, spec, partitions) for name, spec in SOURCE_TABLES.items()}
    return {name: spark.read.parquet(f"{source}/{name}") for name in SOURCE_TABLES}


def _source_counts(spark: SparkSession, source: str, dt: str) -> DataFrame | None:
    return database_counts(spark, source, dt) if source.startswith("jdbc:") else None


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    job = CdcJob(
        args.root,
        dt_policy=args.dt_policy,
        merge_each_batch=not args.append_only,
    )
    if args.files:
        rate = {"maxFilesPerTrigger": str(args.rate)} if args.rate else {}
        raw = stream_files(spark, args.files, **rate)
    else:
        rate = {"maxOffsetsPerTrigger": str(args.rate)} if args.rate else {}
        raw = stream_topic(spark, args.servers, args.topic, **rate)
    trigger = {"availableNow": True} if args.once else None
    if args.configs:
        lines = [r["value"] for r in spark.read.text(args.configs).collect()]
        start_configured(raw, read_configs(lines), f"{args.root}/ods", args.checkpoint, trigger).awaitTermination()
        return
    start_ingest(raw, job, args.checkpoint, trigger).awaitTermination()


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session("layerloom")
    house = daily.Warehouse(spark, args.root)
    if args.command == "run-day":
        sources = _sources(spark, args.source, args.partitions)
        dt = run_dt(args.dt)
        status = daily.run_day(
            spark,
            args.root,
            sources,
            dt,
            strict_counts=args.strict_counts,
            use_digests=args.use_digests,
            source_counts=_source_counts(spark, args.source, dt),
            catalog=args.catalog,
        )
        for step, done in status.items():
            print(step, done)
    elif args.command == "import-changes":
        sources = _sources(spark, args.source, args.partitions)
        now = source_now(spark, args.source) if args.source.startswith("jdbc:") else None
        daily.import_changes(house, sources, run_dt(args.dt), now)
    elif args.command == "validate":
        dt = run_dt(args.dt)
        raw, details = ({t: layer(t, [dt]) for t in SOURCE_TABLES} for layer in (house.ods, house.dwd))
        validate(raw, details).orderBy("check_name", "table_name").show(1000, truncate=False)
    elif args.command == "check":
        sources = _sources(spark, args.source, args.partitions)
        dt = run_dt(args.dt)
        daily.check_counts(house, sources, dt, _source_counts(spark, args.source, dt)).show(truncate=False)
        daily.check_partitions(house, sources, dt).show(truncate=False)
    elif args.command == "backfill":
        daily.backfill_metrics(house, now_text())
    elif args.command == "export":
        export_csv({table: house.dws(table) for table in DWS_SPECS}, args.folder, args.since)
        export_summary(spark, args.folder).show(truncate=False)
    elif args.command == "replay":
        replay_day(spark, CdcJob(args.root), run_dt(args.dt))
    else:
        _ingest(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
