"""The delimited text layout: one row per line, a control character between fields.

The lines are split as whole fields so that an empty field and a NULL stay apart; the CSV
reader would merge them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field delimiter and null token of the layout.
DELIMITER = "\u0001"
NULL_TOKEN = "\\N"


def parse_lines(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Typed rows of a frame of text lines.

    Fields are matched by position. Missing fields and values that do not fit their type are
    NULL; further columns of ``lines`` (such as ``dt``) are kept.
    """
    others = [c for c in lines.columns if c != column]
    parts = lines.select(F.split(F.col(column), DELIMITER, -1).alias("f"), *others)
    fields = []
    for i, field in enumerate(schema.fields):
        text = F.nullif(F.get("f", F.lit(i)), F.lit(NULL_TOKEN))
        typed = text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)
        fields.append(typed.alias(field.name))
    return parts.select(*fields, *others)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table folder of delimited files; ``dt=...`` folders become a text column."""
    lines = spark.read.schema("value string, dt string").text(path)
    columns = T.StructType([f for f in schema.fields if f.name != "dt"])
    return parse_lines(lines, columns)


def line_of(columns: Sequence[str]) -> Column:
    """A row's columns as one line of the same layout.

    The layout has no escapes: a text that holds the delimiter or a line break, or is the null
    token itself, would be read back as something else, so it is an error.
    """

    def field(name: str) -> Column:
        text = F.col(name).cast("string")
        misread = text.rlike("[\\x01\\n\\r]") | (text == NULL_TOKEN)
        message = F.concat(F.lit(f"column {name} holds a value that the text layout cannot carry: "), text)
        return F.when(misread, F.raise_error(message)).otherwise(F.coalesce(text, F.lit(NULL_TOKEN)))

    return F.concat_ws(DELIMITER, *[field(c) for c in columns])


def write_delimited(df: DataFrame, path: str) -> None:
    """Write a table folder of delimited files, one folder per ``dt``."""
    columns = [c for c in df.columns if c != "dt"]
    lines = df.select(line_of(columns).alias("value"), "dt")
    lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").text(path)
