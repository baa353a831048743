"""CSV exports of the metric tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.jobs import run_together
from layerloom.params import check_dt

# Exported columns of each metric table.
EXPORT_COLUMNS: dict[str, tuple[str, ...]] = {
    "dws_order_stats_di": ("dt", "total_order_count", "total_order_amount"),
    "dws_user_stats_di": ("dt", "new_user_count", "total_user_count"),
    "dws_product_stats_di": (
        "dt",
        "total_product_count",
        "avg_product_price",
        "high_price_rate",
        "new_product_count",
    ),
    "dws_user_order_basic_di": ("dt", "order_user_count", "order_user_rate"),
}


def trend(df: DataFrame, table: str, since: str) -> DataFrame:
    """The exported series of a metric table from day ``since`` on, in day order."""
    return df.filter(F.col("dt") >= check_dt(since)).select(*EXPORT_COLUMNS[table]).orderBy("dt")


def export_csv(frames: Mapping[str, DataFrame], folder: str, since: str) -> None:
    """One headerless CSV per metric table; a table has one row per day, so one file holds it."""

    def one(table: str) -> None:
        rows = trend(frames[table], table, since).repartition(1).sortWithinPartitions("dt")
        rows.write.mode("overwrite").csv(f"{folder}/{table}", header=False)

    run_together(one, frames)


def export_summary(spark: SparkSession, folder: str) -> DataFrame:
    """``(table_name, row_count)`` of every exported table, 0 for one without rows."""
    lines = spark.read.text(f"{folder}/*")
    name = F.element_at(F.split("_metadata.file_path", "/"), -2)
    counted = lines.groupBy(name.alias("table_name")).agg(F.count(F.lit(1)).alias("row_count"))
    names = F.array(*[F.lit(n) for n in EXPORT_COLUMNS])
    tables = spark.range(1).select(F.explode(names).alias("table_name"), F.lit(0).cast("bigint").alias("row_count"))
    return tables.unionByName(counted).groupBy("table_name").agg(F.sum("row_count").alias("row_count"))
