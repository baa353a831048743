"""Run metrics as a table ``(metric, business, value)`` partitioned by ``date``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.operators.merge import latest_rows
from layerloom.params import check_dt

SCHEMA = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("business", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("date", T.StringType()),
    ]
)

# Metric names and business labels that dashboards query.
SYNC_ROWS = "data_warehouse_sync_rows"
SYNC_TOTAL_ROWS = "data_warehouse_sync_total_rows"
SUCCESS_RATE = "data_warehouse_success_rate"
COST_SECONDS = "data_warehouse_cost_time_seconds"
FLOW_SUCCESS = "data_warehouse_full_flow_success"
FLOW_SECONDS = "data_warehouse_full_flow_cost_time"
STEP_STATUS = "data_warehouse_step_status"
SYNC_LABEL = "sqoop_ods_full_sync"
FLOW_LABEL = "full_data_governance_flow"
STEPS = ("ods_sync", "row_check", "partition_check", "dwd_clean", "dws_agg")

KEYS = ("metric", "business", "date")


def sync_metrics(counts: DataFrame, dt: str | Column) -> DataFrame:
    """Metric rows of an import from ``(table_name, row_count)``: rows per table, total, success.

    ``dt`` may be a column of ``counts``; then every day gets its own rows.
    """
    day = F.lit(dt) if isinstance(dt, str) else dt
    label = F.concat(F.lit(f"{SYNC_LABEL}_"), "table_name")
    # Each count feeds its own row and the totals; one aggregation, so counts are taken once.
    parts = F.array(
        F.struct(F.lit(SYNC_ROWS).alias("metric"), label.alias("business")),
        F.struct(F.lit(SYNC_TOTAL_ROWS).alias("metric"), F.lit(SYNC_LABEL).alias("business")),
        F.struct(F.lit(SUCCESS_RATE).alias("metric"), F.lit(SYNC_LABEL).alias("business")),
    )
    fed = counts.select("row_count", day.alias("date"), F.explode(parts).alias("m"))
    summed = fed.groupBy("m.metric", "m.business", "date").agg(F.sum("row_count").alias("value"))
    value = F.when(F.col("metric") == SUCCESS_RATE, (F.col("value") > 0).cast("bigint")).otherwise(F.col("value"))
    return summed.select("metric", "business", value.alias("value"), "date")


def flow_metrics(
    spark: SparkSession, dt: str, status: Mapping[str, int], sync_seconds: int | None, flow_seconds: int
) -> DataFrame:
    """Status of each step, success of the whole run, and run times measured by the driver."""
    rows = [(STEP_STATUS, f"{FLOW_LABEL}_{step}", int(status.get(step, 0)), dt) for step in STEPS]
    rows.append((FLOW_SUCCESS, FLOW_LABEL, int(all(status.get(s) for s in STEPS)), dt))
    rows.append((FLOW_SECONDS, FLOW_LABEL, flow_seconds, dt))
    if sync_seconds is not None:
        rows.append((COST_SECONDS, SYNC_LABEL, sync_seconds, dt))
    return spark.createDataFrame(rows, SCHEMA)


def merge_metrics(stored: DataFrame, reported: DataFrame) -> DataFrame:
    """Both, where a reported row replaces the stored one of the same metric, label and day."""
    both = stored.withColumn("age", F.lit(0)).unionByName(reported.withColumn("age", F.lit(1)))
    return latest_rows(both, KEYS, ["age"]).drop("age").select(*SCHEMA.names)


def distinct_lines(metrics: DataFrame) -> DataFrame:
    """Only exact repetitions removed: two values of one metric both stay."""
    return metrics.dropDuplicates(SCHEMA.names)


def text_lines(metrics: DataFrame) -> DataFrame:
    """Metric rows as ``name{business="...",date="..."} value`` lines."""
    line = F.format_string('%s{business="%s",date="%s"} %d', "metric", "business", "date", "value")
    return metrics.select(line.alias("line"))


def lookup(
    metrics: DataFrame,
    date: str | None = None,
    business: str | None = None,
    pattern: str | None = None,
    names: Sequence[str] = (),
) -> DataFrame:
    """Metric rows by day, exact label, label pattern (whole label), and any of some names."""
    if date is not None:
        metrics = metrics.filter(F.col("date") == check_dt(date))
    if business is not None:
        metrics = metrics.filter(F.col("business") == business)
    if pattern is not None:
        metrics = metrics.filter(F.col("business").rlike(f"^(?:{pattern})$"))
    if names:
        metrics = metrics.filter(F.col("metric").isin(*names))
    return metrics


class MetricStore:
    """The stored metrics. A run writes only the partitions of its own days."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def report(self, metrics: Iterable[DataFrame], date: str) -> None:
        """Upsert the metrics of one day."""
        reported = reduce(DataFrame.unionByName, metrics)
        stored = self.read().filter(F.col("date") == check_dt(date))
        self._replace(merge_metrics(stored, reported), date)

    def purge(self, date: str) -> None:
        self._replace(self.spark.createDataFrame([], SCHEMA), date)

    def _replace(self, metrics: DataFrame, date: str) -> None:
        # The few rows of the day are held by the driver, since they may come from the
        # partition that is replaced.
        rows = self.spark.createDataFrame(metrics.filter(F.col("date") == date).collect(), SCHEMA)
        rows.drop("date").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/date={date}")
