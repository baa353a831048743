"""Published loads of raw tables.

A raw table has ``dt=<day>/load=<name>@<number>`` folders, one for each import, window or stream batch. A load that
is repeated gets the next number and a folder of its own. It counts once its marker ``_published/dt=<day>/load=<name>@<number>``
is there; readers take the greatest published number of each load and nothing else. So a half-written load is invisible, and one
that is replaced stays readable until its successor is published; only then are its marker and its folder removed.

``compact_day`` folds the loads of a day into one sorted load. Its marker names the loads that it holds, and these
do not count from the moment that it is there, whether or not they are removed already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.sinks.tables import _folder, _options, overwrite_found_partitions

# The folder of markers, the load that holds folded ones, and the folder of rows without a day.
MARKERS = "_published"
COMPACT = "compact"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Load:
    dt: str
    name: str
    number: int

    @property
    def folder(self) -> str:
        return f"dt={self.dt}/load={self.stored}"

    @property
    def stored(self) -> str:
        return f"{self.name}@{self.number:06d}"


def _found(spark: SparkSession, path: str, dts: Iterable[str] | None = None, load: str = "*", markers: bool = True) -> list[Load]:
    """Markers or folders of a table, from one listing."""
    base = f"{path.rstrip('/')}/{MARKERS}" if markers else path.rstrip("/")
    days = "*" if dts is None else "{" + ",".join(sorted(set(dts))) + "}"
    system, pattern = _folder(spark, f"{base}/dt={days}/load={load}@*")
    loads = []
    for status in system.globStatus(pattern) or []:
        name, _, number = status.getPath().getName().removeprefix("load=").rpartition("@")
        if number.isdigit():
            loads.append(Load(status.getPath().getParent().getName().removeprefix("dt="), name, int(number)))
    return loads


def _covered(spark: SparkSession, path: str, load: Load) -> set[str]:
    """The loads that a folded one holds, from its marker."""
    marker = f"{path.rstrip('/')}/{MARKERS}/{load.folder}"
    return {row["value"] for row in spark.read.text(marker.replace("{", "\\{")).collect()}


def published(spark: SparkSession, path: str, dts: Iterable[str] | None = None) -> list[Load]:
    """The loads that count: one for each day and name, without those that a folded load holds."""
    newest: dict[tuple[str, str], Load] = {}
    for load in _found(spark, path, dts):
        known = newest.get((load.dt, load.name))
        if known is None or known.number < load.number:
            newest[load.dt, load.name] = load
    for day, name in [k for k in newest if k[1] == COMPACT]:
        for held in _covered(spark, path, newest[day, name]):
            newest.pop((day, held), None)
    return sorted(newest.values(), key=lambda x: (x.dt, x.name))


def read_loads(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    dts: Iterable[str] | None = None,
    wanted: Callable[[str], bool] = lambda name: True,
    fmt: str = "parquet",
) -> DataFrame:
    """Rows of the published loads whose name is ``wanted``, with ``load``, the name; only their folders are listed."""
    loads = [load for load in published(spark, path, dts) if load.name == COMPACT or wanted(load.name)]
    names = [f.name for f in schema.fields]
    if not loads:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("from_load", T.StringType())])
    rows = spark.read.format(fmt).schema(stored).option("basePath", path).load([f"{path}/{load.folder}" for load in loads])
    number = F.length(F.substring_index("load", "@", -1))
    name = F.coalesce("from_load", F.left("load", F.length("load") - number - 1))
    rows = rows.withColumn("load", name)
    folded = [n for load in loads if load.name == COMPACT for n in _covered(spark, path, load)]
    if unwanted := sorted({n for n in folded if not wanted(n)}):
        rows = rows.filter(~F.col("load").isin(unwanted))
    return rows.select(*names)


def next_number(spark: SparkSession, path: str, name: str) -> int:
    """One more than any folder or marker of the load has."""
    seen = _found(spark, path, load=name) + _found(spark, path, load=name, markers=False)
    return 1 + max((load.number for load in seen), default=0)


def write_load(df: DataFrame, path: str, dt: str, name: str, fmt: str = "parquet") -> Load:
    """Write the rows as a load of one day; not published yet."""
    load = Load(dt, name, next_number(df.sparkSession, path, name))
    df.drop("dt", "load").write.mode("overwrite").format(fmt).options(**_options(fmt)).save(f"{path}/{load.folder}")
    return load


def write_counted(df: DataFrame, path: str, dt: str, name: str, fmt: str = "parquet") -> tuple[Load, int]:
    """``write_load``, and the rows that it wrote, counted on their way to the writer."""
    seen = Observation(f"rows of {name}")
    load = write_load(df.observe(seen, F.count(F.lit(1)).alias("row_count")), path, dt, name, fmt)
    return load, int(seen.get.get("row_count", 0))


def write_load_days(df: DataFrame, path: str, name: str, dts: Iterable[str | None]) -> list[Load]:
    """Write the rows as a load of the days that they have, given as ``dts``; not published yet.

    Spread by day: every task of a large batch would write a file into every day otherwise.
    """
    number = next_number(df.sparkSession, path, name)
    loads = [Load(NO_DAY if dt is None else dt, name, number) for dt in dts]
    if loads:
        overwrite_found_partitions(df.withColumn("load", F.lit(loads[0].stored)), path, by=("dt", "load"), spread=True)
    for load in loads:
        system, folder = _folder(df.sparkSession, f"{path.rstrip('/')}/{load.folder}")
        system.mkdirs(folder)  # a day without rows
    return loads


def publish(spark: SparkSession, path: str, loads: Iterable[Load], everywhere: bool = True, holds: Iterable[str] = ()) -> list[Load]:
    """Let the loads count, then remove what they replace; returns the loads that were removed.

    Earlier numbers of a load are replaced on all days (a window or batch can have moved to other days), or with
    ``everywhere=False`` on the days of ``loads`` alone.
    """
    loads = list(loads)
    for load in loads:
        _mark(spark, path, load, holds)
    gone = []
    for name, number in {(load.name, load.number) for load in loads}:
        days = None if everywhere else [load.dt for load in loads if load.name == name]
        gone += [old for old in _found(spark, path, days, name) + _found(spark, path, days, name, markers=False) if old.number < number]
    return remove(spark, path, gone)


def _mark(spark: SparkSession, path: str, load: Load, holds: Iterable[str]) -> None:
    """The marker appears with all its lines at once, by a rename."""
    system, marker = _folder(spark, f"{path.rstrip('/')}/{MARKERS}/{load.folder}")
    _, draft = _folder(spark, f"{path.rstrip('/')}/{MARKERS}/_draft/{load.dt}-{load.stored}")
    stream = system.create(draft, True)
    stream.write("".join(f"{name}\n" for name in sorted(holds)).encode())
    stream.close()
    system.mkdirs(marker.getParent())
    system.delete(marker, False)
    if not system.rename(draft, marker):
        raise OSError(f"could not publish {load.folder} of {path}")


def remove(spark: SparkSession, path: str, loads: Iterable[Load]) -> list[Load]:
    """Remove loads: first their markers, so that no reader starts on them, then their folders."""
    loads = sorted(set(loads), key=lambda x: (x.dt, x.name, x.number))
    for base in (f"{path.rstrip('/')}/{MARKERS}", path.rstrip("/")):
        for load in loads:
            system, folder = _folder(spark, f"{base}/{load.folder}")
            system.delete(folder, True)
    return loads


def remove_unpublished(spark: SparkSession, path: str, dts: Iterable[str] | None = None) -> list[Load]:
    """Remove folders without a marker, which failed writers left. Not while a writer is at work on these days."""
    dts = None if dts is None else list(dts)
    return remove(spark, path, set(_found(spark, path, dts, markers=False)) - set(_found(spark, path, dts)))


def compact_day(
    spark: SparkSession, path: str, schema: T.StructType, dt: str, order: Iterable[str], wanted: Callable[[str], bool] = lambda name: True
) -> Load | None:
    """Fold the wanted loads of a day into one, sorted by ``order``; readers see the same rows and names before and after.

    Readers that have listed the folded loads before they are removed read them again from the start.
    """
    held = [load for load in published(spark, path, [dt]) if load.name == COMPACT or wanted(load.name)]
    if len(held) < 2:
        return None
    names = {load.name for load in held if load.name != COMPACT}
    for load in held:
        if load.name == COMPACT:
            names |= _covered(spark, path, load)
    rows = read_loads(spark, path, schema, [dt], lambda name: name in names)
    rows = rows.withColumnRenamed("load", "from_load").hint("rebalance").sortWithinPartitions(*order)
    folded = write_load(rows, path, dt, COMPACT)
    publish(spark, path, [folded], everywhere=False, holds=names)
    remove(spark, path, [load for load in _found(spark, path, [dt]) if load.name in names])
    return folded
