"""Flattening of database change events, the same code for batch and streaming frames.

An event is one JSON text: database, table, change type, epoch milliseconds and the changed
rows. All row values arrive as strings, so rows are parsed to maps and then cast with
``try_cast``; parsing straight to typed fields would turn quoted numbers into NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.times import business_day, epoch_ms_day, epoch_ms_text
from layerloom.params import check_policy
from layerloom.schemas import SOURCE_DATABASE, TableSpec

# Field names of a change event.
ENVELOPE = "database string, `table` string, type string, ts bigint, data array<map<string,string>>"

SOURCE_POSITION = ("src_partition", "src_offset")


def parse_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parse the event text once. Malformed events keep their text and have no table.

    The parsed struct is unpacked by a generator: a filter on its fields cannot be pushed
    below that, where it would parse every text a second time. Adds ``ts_ltz``, the event
    time that watermarks use.
    """
    event = F.from_json(F.col(value).cast("string"), ENVELOPE)
    position = [c for c in SOURCE_POSITION if c in raw.columns]
    parsed = raw.select(F.col(value).cast("string").alias("raw"), *position, F.inline(F.array(event)))
    return parsed.withColumn("ts_ltz", F.timestamp_millis("ts"))


# Change types whose events carry rows.
ROW_CHANGES = ("INSERT", "UPDATE", "DELETE")


def bad_events(parsed: DataFrame) -> DataFrame:
    """``(raw, reason)`` of events that give no rows although they should.

    ``unroutable``: not JSON, or without database, table or change type. ``payload``: a row change
    whose rows are missing or no list. ``day``: a change without a readable event time. An
    empty list of rows is no error.
    """
    missing = F.col("database").isNull() | F.col("table").isNull() | F.col("type").isNull()
    payload = F.col("type").isin(*ROW_CHANGES) & F.col("data").isNull()
    day = F.col("type").isin(*ROW_CHANGES) & F.col("ts").isNull()
    reason = F.when(missing, "unroutable").when(payload, "payload").when(day, "day")
    return parsed.select("raw", reason.alias("reason")).filter("reason is not null")


def rows_without_day(rows: DataFrame) -> DataFrame:
    """``(raw, reason)`` of flattened rows whose day cannot be read, as JSON of the row."""
    return rows.filter("dt is null").select(F.to_json(F.struct("*")).alias("raw"), F.lit("row_day").alias("reason"))


def route(parsed: DataFrame, table: str, database: str = SOURCE_DATABASE) -> DataFrame:
    return parsed.filter((F.col("database") == database) & (F.col("table") == table))


def changed_rows(events: DataFrame, rows: str = "all") -> DataFrame:
    """One output row per changed row; events with no rows give none.

    ``rows="first"`` keeps only the first row of each event.
    """
    if rows == "all":
        return events.select("*", F.posexplode("data").alias("row_pos", "r"))
    if rows == "first":
        first = F.try_element_at("data", F.lit(1))
        return events.select("*", F.lit(0).alias("row_pos"), first.alias("r")).filter(F.col("r").isNotNull())
    raise ValueError(f"rows must be 'all' or 'first', got {rows!r}")


def row_field(key: str, dtype: str) -> Column:
    value = F.col("r").getItem(key)
    return value if dtype == "string" else value.try_cast(dtype)


def partition_day(policy: str, time_column: str, run_date: str | None) -> Column:
    """The ``dt`` of a change under one of the three partition policies."""
    check_policy(policy)
    if policy == "run_date":
        if run_date is None:
            raise ValueError("dt_policy 'run_date' needs run_date")
        return F.lit(run_date)
    if policy == "op_date":
        return epoch_ms_day("ts")
    return business_day(F.col(time_column))


def project_rows(
    rows: DataFrame,
    fields: Sequence[tuple[str, str, str]],
    day: Column,
    key: str | None = None,
    keep_order: bool = False,
) -> DataFrame:
    """Typed columns ``(name, type, json key)`` plus change type, change time and ``dt``."""
    order = [c for c in SOURCE_POSITION if c in rows.columns]
    typed = rows.select(
        *[row_field(json_key, dtype).alias(name) for name, dtype, json_key in fields],
        F.col("type").alias("op_type"),
        epoch_ms_text("ts").alias("op_ts"),
        "ts",
        *order,
        "row_pos",
    )
    if key is not None:
        typed = typed.filter(F.col(key).isNotNull())
    typed = typed.withColumn("dt", day)
    names = [name for name, _, _ in fields] + ["op_type", "op_ts"]
    marks = [F.col("ts").alias("op_ms"), *order, "row_pos"] if keep_order else []
    return typed.select(*names, *marks, "dt")


def flatten_table(
    parsed: DataFrame,
    spec: TableSpec,
    database: str = SOURCE_DATABASE,
    rows: str = "all",
    dt_policy: str = "business_date",
    run_date: str | None = None,
    keep_order: bool = False,
) -> DataFrame:
    """Raw-layer rows of one table, every change type kept, NULL keys rejected.

    ``keep_order`` adds the marks that order two changes of the same second.
    """
    changed = changed_rows(route(parsed, spec.name, database), rows)
    fields = [(name, dtype, name) for name, dtype in spec.columns]
    day = partition_day(dt_policy, spec.time_column, run_date)
    return project_rows(changed, fields, day, spec.key, keep_order)
