"""Ingest driven by a configuration line: ``table|topic|target|col:TYPE:json_key,...``."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.operators.changelog import changed_rows, partition_day, project_rows
from layerloom.schemas import SOURCE_DATABASE

_CAST_TYPES = re.compile(r"(INT|DECIMAL.*)", re.IGNORECASE)
_COMMA_OUTSIDE_PARENTHESES = re.compile(r",(?![^(]*\))")

# Words in a column name that decide its type, first match wins.
TYPE_BY_NAME = (
    (("id", "status", "quantity"), "INT"),
    (("price", "amount"), "DECIMAL(10,2)"),
)


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str
    json_key: str


@dataclass(frozen=True)
class IngestConfig:
    table: str
    topic: str
    target: str
    fields: tuple[Field, ...]


def _cast_type(declared: str) -> str:
    """Whole numbers and decimals are cast; every other declared type stays text."""
    if declared.upper().startswith("BIGINT"):  # also with a display width
        return "bigint"
    return declared.lower() if _CAST_TYPES.fullmatch(declared) else "string"


def type_by_name(column: str) -> str:
    for words, dtype in TYPE_BY_NAME:
        if any(word in column for word in words):
            return dtype
    return "STRING"


def read_config(line: str) -> IngestConfig:
    """A full line: every field names its type and JSON key."""
    table, topic, target, listed = (part.strip() for part in line.split("|", 3))
    fields = []
    for item in filter(None, _COMMA_OUTSIDE_PARENTHESES.split(listed)):
        name, rest = item.split(":", 1)
        dtype, json_key = rest.rsplit(":", 1)
        fields.append(Field(name.strip(), _cast_type(dtype.strip()), json_key.strip()))
    return IngestConfig(table, topic, target, tuple(fields))


def read_short_config(line: str, topic: str = "") -> IngestConfig:
    """A short line ``table|target|col,col,...``: types follow from the column names."""
    table, target, listed = (part.strip() for part in line.split("|", 2))
    names = [name.strip() for name in listed.split(",") if name.strip()]
    fields = tuple(Field(n, _cast_type(type_by_name(n)), n) for n in names)
    return IngestConfig(table, topic, target, fields)


def read_configs(lines: Iterable[str]) -> list[IngestConfig]:
    """All full lines; empty ones and those starting with # are skipped."""
    return [read_config(line) for line in lines if line.strip() and not line.startswith("#")]


def ingest(parsed: DataFrame, config: IngestConfig, rows: str = "all", database: str | None = SOURCE_DATABASE) -> DataFrame:
    """Typed rows of the configured table with ``op_type, op_ts, dt`` (the change day).

    Every changed row of an event counts; ``rows="first"`` takes only the first.
    """
    events = parsed.filter(F.col("table") == config.table)
    if database is not None:
        events = events.filter(F.col("database") == database)
    fields = [(f.name, f.dtype, f.json_key) for f in config.fields]
    return project_rows(changed_rows(events, rows), fields, partition_day("op_date", "", None))
