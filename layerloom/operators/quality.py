"""Data checks. Each returns a frame; the caller decides whether a finding stops the run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.times import day_of, on_day
from layerloom.params import check_dt
from layerloom.schemas import TableSpec

# Fixed value: highest accepted row-count difference, in percent.
TOLERANCE_PCT = 0.1


@dataclass(frozen=True)
class CountPair:
    """Source rows and the raw-layer rows imported from them."""

    table: str
    source: DataFrame
    target: DataFrame


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``, one aggregate per frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def created_on(source: DataFrame, column: str, dt: str) -> DataFrame:
    """Source rows created on day ``dt``; on a timestamp column the range reaches the source."""
    if isinstance(source.schema[column].dataType, T.StringType):
        return source.filter(day_of(column) == F.lit(check_dt(dt)).cast("date"))
    return source.filter(on_day(column, check_dt(dt)))


def total_rows(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"))


def row_count_check(pairs: Sequence[CountPair], tolerance_pct: float = TOLERANCE_PCT) -> DataFrame:
    """Source and target counts by table, their difference in percent, and whether it passes."""
    source = row_counts({p.table: p.source for p in pairs})
    return compare_counts(source, row_counts({p.table: p.target for p in pairs}), tolerance_pct)


def compare_counts(source: DataFrame, target: DataFrame, tolerance_pct: float = TOLERANCE_PCT) -> DataFrame:
    """``row_count_check`` of two frames of counts by table."""
    source = source.withColumnRenamed("row_count", "src")
    target = target.withColumnRenamed("row_count", "tgt")
    both = source.join(target, "table_name")
    empty = F.when(F.col("tgt") == 0, F.lit(0.0)).otherwise(F.lit(100.0))
    share = F.abs(F.col("tgt") - F.col("src")).cast("double") / F.nullif("src", F.lit(0)) * 100
    diff = F.when(F.col("src") == 0, empty).otherwise(share)
    return both.withColumn("diff_pct", diff).withColumn("passed", F.col("diff_pct") < tolerance_pct)


def partition_presence(tables: Mapping[str, DataFrame], days: Sequence[str] | DataFrame) -> DataFrame:
    """``(table_name, dt, present)`` for every expected day of every table.

    ``days`` is a list or a frame with a ``dt`` column. Only the partition column is read.
    """
    any_table = next(iter(tables.values()))
    if not isinstance(days, DataFrame):
        wanted = F.array(*[F.lit(check_dt(d)) for d in days])
        days = any_table.sparkSession.range(1).select(F.explode(wanted).alias("dt"))
    names = F.array(*[F.lit(n) for n in tables])
    expected = days.select("dt").distinct().select(F.explode(names).alias("table_name"), "dt")
    found = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(n).alias("table_name"), "dt").distinct() for n, df in tables.items()],
    ).withColumn("found", F.lit(True))
    joined = expected.join(found, ["table_name", "dt"], "left")
    return joined.select("table_name", "dt", F.coalesce("found", F.lit(False)).alias("present"))


def catalog_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Partition days the catalog knows for a registered table; reads no data."""
    shown = spark.sql(f"SHOW PARTITIONS {table}")
    return shown.select(F.regexp_extract("partition", r"(?:^|/)dt=([^/]+)", 1).alias("dt")).distinct()


# Names that do not count as data files.
NOT_DATA = "_SUCCESS|_tmp|part-r-"


def partition_files(spark: SparkSession, path: str, dt: str | None = None) -> DataFrame:
    """``(dt, data_files, bytes)`` per partition folder, from the file listing alone.

    With ``dt`` only that folder, which has to exist, is listed.
    """
    folder = path if dt is None else f"{path}/dt={check_dt(dt)}"
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    files = listing.select(
        F.regexp_extract("path", r"/dt=([^/]+)/", 1).alias("dt"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "length",
    ).filter(F.col("dt") != "")
    data = files.filter(~F.col("name").rlike(NOT_DATA))
    return data.groupBy("dt").agg(F.count(F.lit(1)).alias("data_files"), F.sum("length").alias("bytes"))


def op_type_census(df: DataFrame, by: Sequence[str] = ("dt",)) -> DataFrame:
    return df.groupBy(*by, "op_type").agg(F.count(F.lit(1)).alias("row_count"))


def duplicate_keys(df: DataFrame, key: str, by: Sequence[str] = ("dt",)) -> DataFrame:
    """Keys that occur more than once; empty when the key is unique."""
    counts = df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter("row_count > 1")


def price_below_zero() -> Column:
    return F.col("price") < 0


def status_out_of_domain() -> Column:
    # States a detail row may have.
    return ~F.col("order_status").isin(1, 2, 3, -1)


def violations(df: DataFrame, rule: Column) -> DataFrame:
    """Rows that break a rule; a NULL outcome is no violation."""
    return df.filter(rule)


def violation_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(rule, violations)`` for all rules of a table in one pass."""
    return _long(df, {name: F.count_if(rule) for name, rule in rules.items()}, "rule", "violations")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, nulls)`` for all columns in one pass."""
    return _long(df, {c: F.count_if(F.col(c).isNull()) for c in columns}, "column_name", "nulls")


def _long(df: DataFrame, aggregates: Mapping[str, Column], name: str, value: str) -> DataFrame:
    one_row = df.agg(*[c.alias(n) for n, c in aggregates.items()])
    return one_row.unpivot([], list(aggregates), name, value)


def foreign_key_orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values of a foreign key without a parent row, and how many child rows hold them.

    Both sides are counted per value in one aggregation instead of an anti join: the optimizer
    would push that join under the count and shuffle every child row. This way a hot value
    leaves each task as one row.
    """
    held = child.select(F.col(column).alias("key_value"), F.lit(1).alias("child"), F.lit(0).alias("parent"))
    known = parent.select(F.col(parent_key).alias("key_value"), F.lit(0).alias("child"), F.lit(1).alias("parent"))
    counts = held.unionByName(known).filter("key_value is not null").groupBy("key_value")
    counts = counts.agg(F.sum("child").alias("row_count"), F.max("parent").alias("parent"))
    return counts.filter("parent = 0").select("key_value", "row_count")


def declared_orphans(frames: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """Orphans of every declared foreign key: ``(child_table, column_name, key_value, row_count)``."""
    found = [
        foreign_key_orphans(frames[spec.name], column, frames[parent], specs[parent].key).select(
            F.lit(spec.name).alias("child_table"), F.lit(column).alias("column_name"), "key_value", "row_count"
        )
        for spec in specs.values()
        for column, parent in spec.foreign_keys
        if spec.name in frames and parent in frames
    ]
    return reduce(DataFrame.unionByName, found)
