"""Partitioned table writers.

A table is a folder with ``dt=...`` partitions; for the loads of raw tables see ``sinks.loads``. Rows are written from the tasks that hold
them; ``spread=True`` first rebalances by ``dt`` for backfills over many days, where AQE
splits a day that is larger than a normal partition instead of sending it to one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the marker file of a finished partition.
SUCCESS_FILE = "_SUCCESS"


def _options(fmt: str) -> dict[str, str]:
    return {"compression": "snappy"} if fmt in ("orc", "parquet") else {}


def partition_path(path: str, dt: str) -> str:
    return f"{path.rstrip('/')}/dt={dt}"


class RouteConflict(RuntimeError):
    """A detail table is written by the other ingest route."""


# The ingest routes; a marker file names the one that owns a detail table.
ROUTES = ("batch", "stream")


def claim_route(spark: SparkSession, path: str, route: str) -> None:
    """Make ``route`` the owner of a detail table; another owner is an error.

    Batch cleansing and stream merge both replace whole days, so one would undo the other.
    """
    for other in ROUTES:
        system, marker = _folder(spark, f"{path.rstrip('/')}/_route_{other}")
        if other != route and system.exists(marker):
            raise RouteConflict(f"{path} is written by the {other} route, not by the {route} route")
    system, marker = _folder(spark, f"{path.rstrip('/')}/_route_{route}")
    if not system.exists(marker):
        system.create(marker, True).close()


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in declared order and type; a value that does not fit is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def overwrite_partition(df: DataFrame, path: str, dt: str, fmt: str = "parquet") -> None:
    """Replace one partition. An empty input leaves an empty partition."""
    rows = df.drop("dt")
    rows.write.mode("overwrite").format(fmt).options(**_options(fmt)).save(partition_path(path, dt))


def overwrite_found_partitions(
    df: DataFrame, path: str, fmt: str = "parquet", by: tuple[str, ...] = ("dt",), spread: bool = False
) -> None:
    """Replace the partitions that occur in the input. An empty input changes nothing."""
    if spread:
        df = df.hint("rebalance", *by)
    writer = df.write.mode("overwrite").format(fmt).options(**_options(fmt))
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by).save(path)


def append_partitions(df: DataFrame, path: str, fmt: str = "parquet", spread: bool = False) -> None:
    if spread:
        df = df.hint("rebalance", "dt")
    df.write.mode("append").format(fmt).options(**_options(fmt)).partitionBy("dt").save(path)


def clear_partitions(spark: SparkSession, path: str, dts: Iterable[str], schema: T.StructType, fmt: str = "parquet") -> None:
    """Empty partitions whose rows are all gone."""
    empty = spark.createDataFrame([], schema)
    for dt in dts:
        overwrite_partition(empty, path, dt, fmt)


def _folder(spark: SparkSession, path: str):
    """File system and path handle of a folder on the driver."""
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def partition_exists(spark: SparkSession, path: str, dt: str) -> bool:
    """Whether the partition folder is there, with or without rows."""
    system, folder = _folder(spark, partition_path(path, dt))
    return system.exists(folder)


def partition_days(spark: SparkSession, path: str) -> list[str]:
    """The ``dt`` values of a table's partition folders, in order; one per day."""
    system, folder = _folder(spark, path)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(name.removeprefix("dt=") for name in names if name.startswith("dt="))


def drop_days_from(spark: SparkSession, path: str, dt: str) -> None:
    """Remove the partitions of ``dt`` and all later days."""
    for day in partition_days(spark, path):
        if day >= dt:
            drop_partition(spark, path, day)


def drop_partition(spark: SparkSession, path: str, dt: str) -> None:
    """Remove a partition folder and its rows."""
    system, folder = _folder(spark, partition_path(path, dt))
    system.delete(folder, True)


def read_partitions(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", dts: Iterable[str] | None = None
) -> DataFrame:
    """A table with its declared schema, so that ``dt`` stays text. Empty if never written.

    With ``dts`` only those partition folders are listed; reading a day of a table with years
    of partitions would otherwise list all of them first.
    """
    if dts is None:
        system, folder = _folder(spark, path)
        folders = [path] if system.exists(folder) else []
    else:
        folders = [partition_path(path, dt) for dt in dts if partition_exists(spark, path, dt)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).option("basePath", path).load(folders)


def publish_partitions(spark: SparkSession, path: str, dts: Iterable[str], table: str | None = None) -> None:
    """Mark partitions finished and, for a catalog table, register them."""
    dts = list(dts)
    for dt in dts:
        system, marker = _folder(spark, f"{partition_path(path, dt)}/{SUCCESS_FILE}")
        system.create(marker, True).close()
    if table is not None and dts:
        partitions = " ".join(f"PARTITION (dt='{dt}')" for dt in dts)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partitions}")


def register_table(
    spark: SparkSession, table: str, path: str, schema: T.StructType, fmt: str = "parquet", by: tuple[str, ...] = ("dt",), repair: bool = True
) -> None:
    """A catalog table over a table folder; existing partitions are picked up, unless they are added one by one."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt} PARTITIONED BY ({', '.join(by)}) LOCATION '{path}'"
    )
    if repair:
        spark.sql(f"MSCK REPAIR TABLE {table}")
