"""The layered run of one business day: import, checks, detail layer, metric layer.

Every step is a set of independent Spark jobs, submitted together. Steps read what the step
before has written, so a lost executor costs the tasks of the current step only.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.jobs import run_together
from layerloom.operators import history
from layerloom.operators import metrics as topic
from layerloom.operators.clean import CLEANERS
from layerloom.operators.quality import (
    compare_counts,
    created_on,
    partition_files,
    row_counts,
)
from layerloom.params import now_text, run_dt
from layerloom.plans.runlog import STEPS, MetricStore, flow_metrics, sync_metrics
from layerloom.schemas import IMPORTED, SOURCE_TABLES, dws_schema
from layerloom.sinks import loads
from layerloom.sinks.tables import (
    claim_route,
    conform,
    drop_days_from,
    overwrite_found_partitions,
    overwrite_partition,
    partition_days,
    publish_partitions,
    read_partitions,
    register_table,
)
from layerloom.sources.marks import MarkStore
from layerloom.sources.relational import import_full, import_incremental


class CheckFailed(RuntimeError):
    """A check that stops the run found something."""


@dataclass(frozen=True)
class Warehouse:
    """Folder layout of the layers.

    Raw tables have published loads (``sinks.loads``): full imports write the load ``full``, windows
    ``since_<mark>``, streams a load per batch. With ``catalog``, a database, every import
    and every layer registers its tables and partitions there.
    """

    spark: SparkSession
    root: str
    catalog: str | None = None
    mark_folder: str = "marks"

    def ods_path(self, table: str) -> str:
        return f"{self.root}/ods/{SOURCE_TABLES[table].ods_name}"

    def dwd_path(self, table: str) -> str:
        return f"{self.root}/dwd/{SOURCE_TABLES[table].dwd_name}"

    def dws_path(self, table: str) -> str:
        return f"{self.root}/dws/{table}"

    def ods(self, table: str, dts: list[str] | None = None) -> DataFrame:
        """Imported rows; the change log of a stream in the same table is not among them.

        A day can have a snapshot and windows that were read after it. The rows of its newest load with a key count;
        rows of one load stay as they are, and so do rows without a key.
        """
        path, wanted = self.ods_path(table), lambda name: re.match(IMPORTED, name) is not None

        def read(days: list[str] | None, named: Callable[[str], bool]) -> DataFrame:
            return loads.read_loads(self.spark, path, _raw_schema(table), days, lambda name: wanted(name) and named(name))

        found = [load for load in loads.published(self.spark, path, dts) if wanted(load.name)]
        per_day = Counter(load.dt for load in found)
        mixed = sorted(day for day, n in per_day.items() if n > 1)
        if not mixed:
            return read(dts, lambda name: True).drop("load")
        key = SOURCE_TABLES[table].key
        # windows, which are named after their start, are ranked among themselves; snapshots only lose the keys that windows have
        windows = read(mixed, lambda name: name != "full")
        if max(Counter(load.dt for load in found if load.name != "full").values()) > 1:
            newest = F.max("load").over(Window.partitionBy("dt", key))
            windows = windows.withColumn("newest", newest).filter(F.col(key).isNull() | (F.col("load") == F.col("newest"))).drop("newest")
        snapshots = read(mixed, lambda name: name == "full").drop("load")
        kept = snapshots.join(windows.select("dt", key), ["dt", key], "left_anti").select(*snapshots.columns)
        rows = kept.unionByName(windows.drop("load"))
        if alone := [day for day, n in per_day.items() if n == 1]:
            rows = rows.unionByName(read(alone, lambda name: True).drop("load"))
        return rows

    def publish(self, path: str, dts: list[str], schema: T.StructType, fmt: str = "parquet") -> None:
        """Mark days of a table finished; with a catalog, register the table and the days."""
        name = self._registered(path, schema, fmt, ("dt",), True) if self.catalog else None
        publish_partitions(self.spark, path, dts, name)

    def publish_load(self, table: str, load: loads.Load, replaces: Callable[[str], bool] | None = None) -> None:
        """Let a written load count, then remove what it replaces: its own earlier tries and, on its day, other loads."""
        path = self.ods_path(table)
        before = [x for x in loads.published(self.spark, path, [load.dt]) if replaces and replaces(x.name)]
        gone = loads.publish(self.spark, path, [load], everywhere=replaces is None)
        gone += loads.remove(self.spark, path, before)
        publish_partitions(self.spark, path, [load.dt])
        if self.catalog:
            name = self._registered(path, _raw_schema(table), "parquet", ("dt", "load"), False)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (dt='{load.dt}', load='{load.stored}')")
            for old in gone:
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (dt='{old.dt}', load='{old.stored}')")

    def _registered(self, path: str, schema: T.StructType, fmt: str, by: tuple[str, ...], repair: bool) -> str:
        name = f"{self.catalog}.{path.rsplit('/', 1)[1]}"
        register_table(self.spark, name, path, schema, fmt, by, repair)
        return name

    def dwd(self, table: str, dts: list[str] | None = None) -> DataFrame:
        spec = SOURCE_TABLES[table]
        return read_partitions(self.spark, self.dwd_path(table), spec.dwd_schema(), spec.detail_format, dts)

    def digest_path(self, table: str) -> str:
        return f"{self.root}/digests/{table}"

    def digest(self, table: str, dt: str) -> DataFrame:
        schema = T.StructType.fromDDL(history.DIGEST_SCHEMAS[table] + ", dt string")
        return read_partitions(self.spark, self.digest_path(table), schema, dts=[dt]).drop("dt")

    def dws(self, table: str) -> DataFrame:
        return read_partitions(self.spark, self.dws_path(table), dws_schema(table))

    @property
    def run_metrics(self) -> MetricStore:
        return MetricStore(self.spark, f"{self.root}/run_metrics")

    @property
    def marks(self) -> MarkStore:
        return MarkStore(self.spark, f"{self.root}/{self.mark_folder}")



def _raw_schema(table: str) -> T.StructType:
    return T.StructType([*SOURCE_TABLES[table].ods_schema().fields, T.StructField("load", T.StringType())])


def import_day(house: Warehouse, sources: Mapping[str, DataFrame], dt: str) -> dict[str, int]:
    """Full snapshots of all sources into the raw partition ``dt``; returns the rows written per table."""
    written: dict[str, int] = {}

    def one(name: str) -> None:
        rows = import_full(sources[name], SOURCE_TABLES[name], dt)
        # a full snapshot of the day stands for the imports of that day before it, and for no other day
        load, written[name] = loads.write_counted(rows, house.ods_path(name), dt, "full")
        house.publish_load(name, load, replaces=lambda other: other.startswith("since_"))

    run_together(one, sources)
    return written


def import_changes(
    house: Warehouse, sources: Mapping[str, DataFrame], dt: str, now: str | None = None, lag_seconds: int = 0
) -> dict[str, int]:
    """Rows changed since the last import, as a load of the raw partition ``dt``; returns the rows written per table.

    ``now``, the end of the window, is best asked from the source (``source_now``); without it, it is
    UTC, as all times are read. ``lag_seconds`` leaves time for rows that are not committed yet.
    The load is named after the window's start, and the mark of a table moves only after its rows
    are written: a window that failed is read again and replaces what it had written.
    """
    now = now or now_text(lag_seconds)
    written: dict[str, int] = {}

    def one(name: str) -> None:
        last = house.marks.current(name)
        rows = import_incremental(sources[name], SOURCE_TABLES[name], last, now, dt)
        load, written[name] = loads.write_counted(rows, house.ods_path(name), dt, "since_" + re.sub("[^0-9]", "", last))
        house.publish_load(name, load)
        house.marks.advance(name, now)

    run_together(one, sources)
    return written


def written_counts(spark: SparkSession, tables: Iterable[str], written: Mapping[str, int]) -> DataFrame:
    """``(table_name, row_count)`` of an import, as its writers counted; 0 for a table that was not written."""
    return spark.createDataFrame([(t, written.get(t, 0)) for t in sorted(tables)], "table_name string, row_count bigint")


def check_counts(
    house: Warehouse,
    sources: Mapping[str, DataFrame],
    dt: str,
    source_counts: DataFrame | None = None,
    raw_counts: DataFrame | None = None,
) -> DataFrame:
    """Source rows against the raw partition; of orders only those created on ``dt``.

    ``source_counts``, such as ``database_counts``, saves reading the sources again.
    """
    if source_counts is None:
        counted = dict(sources)
        if "o_order" in counted:
            counted["o_order"] = created_on(counted["o_order"], "create_time", dt)
        source_counts = row_counts(counted)
    if raw_counts is None:
        raw_counts = row_counts({name: house.ods(name, [dt]) for name in sources})
    return compare_counts(source_counts, raw_counts)


def check_partitions(house: Warehouse, tables: Iterable[str], dt: str) -> DataFrame:
    """Presence and data files of the raw partition ``dt`` of every table.

    Both come from the folders, so an empty but published partition is present.
    """
    spark = house.spark
    found = {t: bool(loads.published(spark, house.ods_path(t), [dt])) for t in tables}
    expected = spark.createDataFrame([(t, dt, p) for t, p in found.items()], "table_name string, dt string, present boolean")
    files = [
        partition_files(spark, house.ods_path(t), dt).select(F.lit(t).alias("table_name"), "data_files")
        for t, present in found.items()
        if present
    ]
    none = spark.createDataFrame([], "table_name string, data_files bigint")
    listed = reduce(DataFrame.unionByName, files, none)
    counts = F.coalesce("data_files", F.lit(0)).alias("data_files")
    return expected.join(listed, "table_name", "left").select("table_name", "dt", "present", counts)


def clean_day(house: Warehouse, dt: str, etl_time: str) -> None:
    """Replace the detail partitions of ``dt`` and drop the history digests that hold them."""

    def one(name: str) -> None:
        spec = SOURCE_TABLES[name]
        claim_route(house.spark, house.dwd_path(name), "batch")
        drop_days_from(house.spark, house.digest_path(name), dt)
        rows = CLEANERS[name](house.ods(name, [dt]), etl_time)
        overwrite_partition(rows, house.dwd_path(name), dt, spec.detail_format)
        house.publish(house.dwd_path(name), [dt], spec.dwd_schema(), spec.detail_format)

    run_together(one, CLEANERS)


def day_metrics(house: Warehouse, dates: list[str] | None, etl_time: str) -> dict[str, DataFrame]:
    """The four metric frames for the given days, or for all days at once.

    Cumulative metrics read the history; the others read the given days only.
    """
    users_of_day, orders_of_day = house.dwd("u_user", dates), house.dwd("o_order", dates)

    def cumulative(table: str, stats) -> DataFrame:
        if dates is None or len(dates) != 1:
            return stats(house.dwd(table), dates, etl_time)
        # one day: a digest of the history up to it holds every part, from one scan
        digest = history.DIGESTS[table](house.dwd(table).filter(F.col("dt") <= dates[0]))
        return history.STATS[table](digest, dates[0], etl_time)

    return {
        "dws_user_stats_di": cumulative("u_user", topic.user_daily_stats),
        "dws_product_stats_di": cumulative("p_product", topic.product_daily_stats),
        "dws_order_stats_di": topic.order_daily_stats(orders_of_day, dates, etl_time),
        "dws_user_order_basic_di": topic.user_order_daily_stats(users_of_day, orders_of_day, dates, etl_time),
    }


def refresh_digest(house: Warehouse, table: str, dt: str) -> DataFrame:
    """Write the history digest of ``dt`` from the latest earlier one and the days since."""
    spark, path, key = house.spark, house.digest_path(table), SOURCE_TABLES[table].key
    earlier = [day for day in partition_days(spark, path) if day < dt][-1:]
    since = earlier[0] if earlier else ""
    loaded = [day for day in partition_days(spark, house.dwd_path(table)) if since < day <= dt]
    digest = history.DIGESTS[table](house.dwd(table, loaded))
    if earlier:
        digest = history.merge_digests(house.digest(table, since), digest, key)
    overwrite_partition(digest, path, dt)
    return house.digest(table, dt)


def digest_metrics(house: Warehouse, dt: str, etl_time: str) -> dict[str, DataFrame]:
    """The cumulative metric frames of one day, from refreshed digests."""
    names = {"u_user": "dws_user_stats_di", "p_product": "dws_product_stats_di"}
    frames = {}

    def one(table: str) -> None:
        frames[names[table]] = history.STATS[table](refresh_digest(house, table, dt), dt, etl_time)

    run_together(one, names)
    return frames


def aggregate_day(house: Warehouse, dt: str, etl_time: str, use_digests: bool = False) -> None:
    frames = day_metrics(house, [dt], etl_time)
    if use_digests:
        frames |= digest_metrics(house, dt, etl_time)

    def one(table: str) -> None:
        rows = conform(frames[table], dws_schema(table)).coalesce(1)
        overwrite_partition(rows, house.dws_path(table), dt)
        house.publish(house.dws_path(table), [dt], dws_schema(table))

    run_together(one, frames)


def backfill_metrics(house: Warehouse, etl_time: str) -> None:
    """Recompute the metrics of every day of the detail layer in one pass per table."""
    frames = day_metrics(house, None, etl_time)

    def one(table: str) -> None:
        overwrite_found_partitions(conform(frames[table], dws_schema(table)), house.dws_path(table), spread=True)

    run_together(one, frames)


def run_day(
    spark: SparkSession,
    root: str,
    sources: Mapping[str, DataFrame],
    dt: str | None = None,
    etl_time: str | None = None,
    strict_counts: bool = False,
    use_digests: bool = False,
    source_counts: DataFrame | None = None,
    catalog: str | None = None,
) -> dict[str, int]:
    """Run all layers for ``dt`` and record the run metrics; returns the status per step.

    A failing step stops the run; its status and those after it stay 0 and the error is
    raised once the metrics are stored. Missing partitions stop the run; count differences do
    only with ``strict_counts``. ``use_digests`` computes the cumulative metrics from history
    digests, which every writer of detail partitions drops from that day on. ``catalog``
    registers tables and partitions there.
    """
    dt, etl_time = run_dt(dt), etl_time or now_text()
    house = Warehouse(spark, root, catalog)
    written: dict[str, int] = {}

    def count_step() -> None:
        # the check and the run metrics take what the writers counted; no raw file is read for it
        failed = check_counts(house, sources, dt, source_counts, written_counts(spark, sources, written)).filter("not passed")
        if strict_counts and not failed.isEmpty():
            raise CheckFailed(f"row counts differ on {dt}")

    def partition_step() -> None:
        failed = check_partitions(house, sources, dt).filter("not present or data_files = 0")
        if not failed.isEmpty():
            raise CheckFailed(f"raw partitions missing or without files on {dt}")

    steps: dict[str, Callable[[], None]] = {
        "ods_sync": lambda: written.update(import_day(house, sources, dt)),
        "row_check": count_step,
        "partition_check": partition_step,
        "dwd_clean": lambda: clean_day(house, dt, etl_time),
        "dws_agg": lambda: aggregate_day(house, dt, etl_time, use_digests),
    }
    status = dict.fromkeys(STEPS, 0)
    started = time.monotonic()
    sync_seconds = None
    try:
        for step in STEPS:
            steps[step]()
            status[step] = 1
            if step == "ods_sync":
                sync_seconds = round(time.monotonic() - started)
    finally:
        flow_seconds = round(time.monotonic() - started)
        reported = [flow_metrics(spark, dt, status, sync_seconds, flow_seconds)]
        if status["ods_sync"]:
            reported.append(sync_metrics(written_counts(spark, sources, written), dt))
        house.run_metrics.purge(dt)
        house.run_metrics.report(reported, dt)
    return status
