"""Change-log ingest: one stream, parsed once, fanned out to raw and detail tables.

Every micro-batch appends its rows to the raw tables and merges them into the latest change of each key
of the days that it touched. That state is a table of its own, so a batch reads its own rows and the state of those days, not
their log; the log of a day is read where it has no state yet, and by ``replay_day``, which builds the state anew.
A state belongs to one set of merge options: replay the days after changing them.

``foreachBatch`` may run a batch again after a failure. Raw rows are a load named after query and batch, which a second run
replaces; a change that is merged twice stays the latest or does not; detail partitions are overwritten. ``compact_log`` folds the many
loads of a day into one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from layerloom.jobs import run_together
from layerloom.operators.changelog import bad_events, flatten_table, parse_events, rows_without_day
from layerloom.operators.merge import ORDER_COLUMNS, live_rows, merge_rules, newest_changes
from layerloom.params import run_dt
from layerloom.schemas import IMPORTED, SOURCE_DATABASE, SOURCE_TABLES, TableSpec
from layerloom.sinks import loads
from layerloom.sinks.tables import (
    claim_route,
    clear_partitions,
    drop_days_from,
    overwrite_found_partitions,
    publish_partitions,
)
from layerloom.sources.field_list import IngestConfig, ingest

_POSITION = [("src_partition", "int"), ("src_offset", "bigint")]


@dataclass(frozen=True)
class CdcJob:
    """Where and how a change log is stored."""

    root: str
    tables: tuple[str, ...] = tuple(SOURCE_TABLES)
    database: str = SOURCE_DATABASE
    dt_policy: str = "business_date"
    run_date: str | None = None
    etl_time: str | None = None
    merge_each_batch: bool = True
    merge_options: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.merge_options.get("scope", "dt") != "dt":
            raise ValueError("a stream merge recomputes days, so its scope is 'dt'")

    def ods_path(self, spec: TableSpec) -> str:
        return f"{self.root}/ods/{spec.ods_name}"

    def dwd_path(self, spec: TableSpec) -> str:
        return f"{self.root}/dwd/{spec.dwd_name}"

    def state_path(self, spec: TableSpec) -> str:
        return f"{self.root}/state/{spec.ods_name}"

    @property
    def bad_path(self) -> str:
        return f"{self.root}/bad_events"


def change_log_schema(spec: TableSpec) -> T.StructType:
    """The raw table of a change log: declared columns, order marks, ``dt`` and ``load``."""
    declared = [f for f in spec.ods_schema().fields if f.name != "dt"]
    marks = [("op_ms", "bigint"), *_POSITION, ("row_pos", "int"), ("dt", "string"), ("load", "string")]
    return T.StructType(declared + [T.StructField(n, T.DataType.fromDDL(t)) for n, t in marks])


def parse_spread(raw: DataFrame) -> DataFrame:
    """``parse_events`` over evenly dealt messages, persisted for the tables that take rows of them.

    Parsed rows are many times the size of the messages as stored, and one stored file or topic partition can hold a
    whole batch. Dealing out the texts first keeps that from being one parsed block, read whole by one task of each table.
    """
    return parse_events(raw.hint("rebalance")).persist()


def with_position(raw: DataFrame) -> DataFrame:
    """Source position columns, NULL where the source has none."""
    missing = {n: F.lit(None).cast(t) for n, t in _POSITION if n not in raw.columns}
    return raw.withColumns(missing) if missing else raw


def read_change_log(
    spark: SparkSession, job: CdcJob, spec: TableSpec, dts: Sequence[str] | None = None
) -> DataFrame:
    """The published raw log of a table; with ``dts`` only the folders of those days are listed."""
    return loads.read_loads(spark, job.ods_path(spec), change_log_schema(spec), dts)


def append_changes(parsed: DataFrame, job: CdcJob, spec: TableSpec, load: str) -> list[str]:
    """Write and publish one load of a table; returns the days it touched (at most one per calendar day).

    Rows without a day stay in the raw table's default partition, are never merged, and are
    kept as bad events.
    """
    # A stream lives for weeks, so without a fixed date the run date is that of the batch.
    run_date = job.run_date or (run_dt() if job.dt_policy == "run_date" else None)
    rows = flatten_table(parsed, spec, job.database, dt_policy=job.dt_policy, run_date=run_date, keep_order=True)
    _keep_bad(rows_without_day(rows), job.bad_path, f"{load}-{spec.name}")
    days = [row["dt"] for row in rows.select("dt").distinct().collect()]
    path = job.ods_path(spec)
    written = loads.write_load_days(rows, path, load, days)
    loads.publish(rows.sparkSession, path, written)
    touched = sorted(day for day in days if day is not None)
    publish_partitions(rows.sparkSession, path, touched)
    return touched


def state_schema(spec: TableSpec) -> T.StructType:
    """The latest change of each key and day: key, day, order marks, detail columns, kind of change."""
    known = {f.name: f for f in change_log_schema(spec).fields}
    marks = [c for c in ORDER_COLUMNS if c in known]
    names = dict.fromkeys([spec.key, *marks, *spec.detail_columns, "op_type", "dt", "load"])
    return T.StructType([known[n] for n in names])


# Fixed value: the name under which states are stored as loads.
STATE = "state"


def changes_to_merge(spark: SparkSession, job: CdcJob, spec: TableSpec, dts: Sequence[str], load: str | None) -> DataFrame:
    """What decides the latest changes of the days: their state and the rows of ``load``, or their log.

    The log is read of days without a state, and of all days without ``load``.
    """
    log, states = job.ods_path(spec), job.state_path(spec)
    have = {found.dt for found in loads.published(spark, states, dts)} if load else set()
    known, new = [dt for dt in dts if dt in have], [dt for dt in dts if dt not in have]
    columns = [f.name for f in state_schema(spec).fields if f.name != "load"]
    parts = []
    if new:
        parts.append(loads.read_loads(spark, log, change_log_schema(spec), new))
    if known:
        parts.append(loads.read_loads(spark, log, change_log_schema(spec), known, lambda name: name == load))
        parts.append(loads.read_loads(spark, states, state_schema(spec), known))
    rows = parts[0].select(columns)
    for part in parts[1:]:
        rows = rows.unionByName(part.select(columns))
    return rows.filter("op_ms is not null")  # rows of imports in the same raw table have no change time


def merge_days(spark: SparkSession, job: CdcJob, spec: TableSpec, dts: Sequence[str], load: str | None = None) -> None:
    """Merge the rows of ``load`` into the detail partitions ``dts``; without it, build them from the whole log.

    A day whose keys were all deleted has no rows left and is emptied explicitly.
    """
    if not dts:
        return
    claim_route(spark, job.dwd_path(spec), "stream")
    drop_days_from(spark, f"{job.root}/digests/{spec.name}", min(dts))
    states = job.state_path(spec)
    options = {"delete_mode": "filter", "null_op": "drop"} | {k: v for k, v in job.merge_options.items() if k != "scope"}
    newest = newest_changes(changes_to_merge(spark, job, spec, dts, load), spec, **options)
    loads.publish(spark, states, loads.write_load_days(newest, states, STATE, dts), everywhere=False)

    stored = loads.read_loads(spark, states, state_schema(spec), dts)
    live = live_rows(stored, spec, merge_rules(spec.name), job.etl_time)
    path, fmt = job.dwd_path(spec), spec.detail_format
    overwrite_found_partitions(live, path, fmt, spread=True)
    left = {row["dt"] for row in live.select("dt").distinct().collect()}
    clear_partitions(spark, path, sorted(set(dts) - left), spec.dwd_schema(), fmt)
    publish_partitions(spark, path, dts)


def compact_log(spark: SparkSession, job: CdcJob, dt: str) -> None:
    """Fold the change loads of one day into one sorted load for each table; imports stay as they are."""

    def one_table(name: str) -> None:
        spec = SOURCE_TABLES[name]
        order = [spec.key, *(c for c in ORDER_COLUMNS if c in change_log_schema(spec).names)]
        loads.compact_day(spark, job.ods_path(spec), change_log_schema(spec), dt, order, lambda load: not re.match(IMPORTED, load))

    run_together(one_table, job.tables)


def _keep_bad(bad: DataFrame, path: str, load: str) -> None:
    overwrite_found_partitions(bad.withColumn("load", F.lit(load)), path, by=("load",))


def replay_day(spark: SparkSession, job: CdcJob, dt: str) -> None:
    """Run the merge of one day again for all tables; the result is the same each time."""
    for name in job.tables:
        merge_days(spark, job, SOURCE_TABLES[name], [dt])


def apply_batch(raw: DataFrame, job: CdcJob, load: str) -> None:
    """One micro-batch: parse, keep bad events aside, then append and merge every table.

    Also takes a bounded read of the topic; ``load`` then names that read.
    """
    spark = raw.sparkSession
    parsed = parse_spread(with_position(raw))
    try:
        _keep_bad(bad_events(parsed), job.bad_path, load)

        def one_table(name: str) -> None:
            spec = SOURCE_TABLES[name]
            touched = append_changes(parsed, job, spec, load)
            if job.merge_each_batch:
                merge_days(spark, job, spec, touched, load)

        run_together(one_table, job.tables)
    finally:
        parsed.unpersist()


def start_ingest(raw: DataFrame, job: CdcJob, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start the ingest of a streaming frame with a ``value`` column.

    The load name holds the query id that the checkpoint keeps, so a query started with a new
    checkpoint never replaces loads of an older one.
    """

    return _start_loads(raw, lambda batch, load: apply_batch(batch, job, load), checkpoint, trigger)


def _start_loads(
    raw: DataFrame, apply: Callable[[DataFrame, str], None], checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        apply(batch, f"{query_id}-{batch_id}")

    writer = raw.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()


def start_configured(
    raw: DataFrame,
    configs: Sequence[IngestConfig],
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Append the configured tables of one topic to ``root/<target>``, partitioned by change day."""
    by_target = {config.target: config for config in configs}

    def apply(batch: DataFrame, load: str) -> None:
        parsed = parse_spread(batch)
        try:
            _keep_bad(bad_events(parsed), f"{root}/bad_events", load)

            def one_target(target: str) -> None:
                rows = ingest(parsed, by_target[target], **options).withColumn("load", F.lit(load))
                overwrite_found_partitions(rows, f"{root}/{target}", by=("dt", "load"), spread=True)

            run_together(one_target, by_target)
        finally:
            parsed.unpersist()

    return _start_loads(raw, apply, checkpoint, trigger)


def start_append(
    raw: DataFrame, spec: TableSpec, path: str, checkpoint: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    """Only append one table's changes, by load, and keep bad events under ``path`` + ``_bad``."""

    def apply(batch: DataFrame, load: str) -> None:
        parsed = parse_spread(batch)
        try:
            _keep_bad(bad_events(parsed), f"{path}_bad", load)
            rows = flatten_table(parsed, spec, **options).withColumn("load", F.lit(load))
            overwrite_found_partitions(rows, path, by=("dt", "load"), spread=True)
        finally:
            parsed.unpersist()

    return _start_loads(raw, apply, checkpoint, trigger)
