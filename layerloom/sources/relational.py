"""Imports from a relational source: full snapshots and half-open time windows.

A source is any DataFrame, normally ``read_table`` over JDBC. Column selection and the
window predicate are plain DataFrame operations, which Spark pushes into the source query.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.times import time_text
from layerloom.params import check_dt
from layerloom.schemas import ORDER, SOURCE_TABLES, TableSpec


def read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int = 1,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC read, split on an integer key when its bounds are given.

    Date-times arrive without a zone, as the source stores them.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true", **extra}
    if num_partitions > 1:
        if partition_column is None or bounds is None:
            raise ValueError("a split read needs partition_column and bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(num_partitions),
        }
    return options


def _ask(spark: SparkSession, query: str, options: dict[str, str]) -> DataFrame:
    """A query the database answers itself, so that only its result travels."""
    rest = {k: v for k, v in options.items() if k != "dbtable"}
    return spark.read.format("jdbc").options(**rest).option("query", query).load()


def bounds_query(spec: TableSpec) -> str:
    return f"SELECT MIN({spec.key}) AS low_key, MAX({spec.key}) AS high_key FROM {spec.name}"


def count_query(spec: TableSpec, dt: str | None = None) -> str:
    """Row count of a table, with ``dt`` only of rows created on that day."""
    query = f"SELECT COUNT(*) AS row_count FROM {spec.name}"
    if dt is None:
        return query
    after = date.fromisoformat(check_dt(dt)) + timedelta(days=1)
    column = spec.time_column
    return f"{query} WHERE {column} >= '{dt} 00:00:00' AND {column} < '{after} 00:00:00'"


def database_counts(spark: SparkSession, url: str, dt: str, **extra: str) -> DataFrame:
    """``(table_name, row_count)`` of all source tables; of orders only those created on ``dt``."""
    counts = [
        _ask(spark, count_query(spec, dt if spec is ORDER else None), read_options(url, spec.name, **extra)).select(
            F.lit(name).alias("table_name"), F.col("row_count").cast("bigint").alias("row_count")
        )
        for name, spec in SOURCE_TABLES.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def read_table(
    spark: SparkSession,
    url: str,
    spec: TableSpec,
    num_partitions: int = 16,
    predicates: list[str] | None = None,
    **extra: str,
) -> DataFrame:
    """A source table over JDBC, by default read in ranges of its integer key.

    Ids with gaps make ranges uneven; ``predicates``, such as ``spread_predicates``, then
    give the parts instead. One partition has to be asked for.
    """
    options = read_options(url, spec.name, **extra)
    if predicates is not None:
        asked = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(url, spec.name, predicates=predicates, properties=asked)
    if num_partitions > 1:
        low, high = _ask(spark, bounds_query(spec), options).first()
        if low is not None:
            options = read_options(url, spec.name, spec.key, (low, high), num_partitions, **extra)
    return spark.read.format("jdbc").options(**options).load()


def spread_predicates(spec: TableSpec, parts: int) -> list[str]:
    """Disjoint conditions that deal rows by the remainder of their key, whatever gaps ids have."""
    first = f"MOD({spec.key}, {parts}) = 0 OR {spec.key} IS NULL"
    return [first, *[f"MOD({spec.key}, {parts}) IN ({i}, {i - parts})" for i in range(1, parts)]]


def now_query() -> str:
    return "SELECT CURRENT_TIMESTAMP AS source_time"


def source_now(spark: SparkSession, url: str, **extra: str) -> str:
    """The clock of the source, in the zone in which it stores its times."""
    asked = _ask(spark, now_query(), read_options(url, "", **extra)).select(F.date_format("source_time", "yyyy-MM-dd HH:mm:ss"))
    return asked.first()[0]


def _raw_columns(source: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared columns with declared types; date-times become text."""
    types = dict(source.dtypes)
    columns = []
    for name, dtype in spec.columns:
        is_time = types[name].startswith("timestamp")
        value = time_text(name) if is_time and dtype == "string" else F.col(name).cast(dtype)
        columns.append(value.alias(name))
    # Full and windowed imports carry no change type; change-log rows do.
    nothing = F.lit(None).cast("string")
    return source.select(*columns, nothing.alias("op_type"), nothing.alias("op_ts"))


def import_full(source: DataFrame, spec: TableSpec, dt: str) -> DataFrame:
    """A snapshot of the source table as rows of the raw partition ``dt``."""
    return _raw_columns(source, spec).withColumn("dt", F.lit(dt))


def time_window(source: DataFrame, column: str, last: str, now: str) -> DataFrame:
    """Rows with ``last <= column < now``."""
    low, high = F.lit(last), F.lit(now)
    kind = source.schema[column].dataType
    if not isinstance(kind, T.StringType):
        low, high = low.cast(kind), high.cast(kind)
    return source.filter((F.col(column) >= low) & (F.col(column) < high))


def import_incremental(
    source: DataFrame, spec: TableSpec, last: str, now: str, dt: str, column: str = "update_time"
) -> DataFrame:
    """Rows changed in the window, as rows to append to the raw partition ``dt``."""
    return import_full(time_window(source, column, last, now), spec, dt)
