"""High-water marks of incremental imports.

Marks are an append-only table ``(table_name, mark)``; the current mark of a table is its
greatest. Nothing is overwritten, so a failed run leaves the old mark in force, and each
table has its own mark, so a retry does not import finished tables again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the mark of a table that was never imported.
FIRST_MARK = "1970-01-01 00:00:00"
_SCHEMA = "table_name string, mark string"


class MarkStore:
    """Each table's marks lie in a folder of their own, so tables may finish at the same time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def marks(self, tables: Sequence[str]) -> DataFrame:
        """``(table_name, mark)`` for every asked table."""
        names = F.array(*[F.lit(t) for t in tables])
        asked = self.spark.range(1).select(F.explode(names).alias("table_name"), F.lit(FIRST_MARK).alias("mark"))
        try:
            asked = asked.unionByName(self.spark.read.schema(_SCHEMA).parquet(self.path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        known = asked.filter(F.col("table_name").isin(*tables))
        return known.groupBy("table_name").agg(F.max("mark").alias("mark"))

    def current(self, table: str) -> str:
        return self.marks([table]).first()["mark"]

    def advance(self, table: str, mark: str) -> None:
        """Record the mark of a table whose rows are written."""
        row = self.spark.range(1).select(F.lit(mark).alias("mark"))
        row.write.mode("append").parquet(f"{self.path}/table_name={table}")
