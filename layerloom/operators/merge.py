"""Latest-row merge of a change log into the detail layer.

The latest row per key is ``max(struct(order columns, other columns))``. Rows are reduced on
the map side before the shuffle, so a key with very many versions sends one row per task,
and the comparison over all columns makes the winner of a tie the same on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.rules import checked_status, non_negative
from layerloom.functions.times import load_time
from layerloom.schemas import DATA_SOURCE, ORDER, PRODUCT, SOURCE_TABLES, USER, TableSpec

DELETE = "DELETE"
# Order of two changes of one key: operation second, then whatever finer marks the log kept.
ORDER_COLUMNS = ("op_ts", "op_ms", "src_partition", "src_offset", "row_pos", "seq")


def latest_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest in ``order_by``, NULL sorting lowest."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    newest = F.max(F.struct(*order_by, *rest)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*[_pick(c, keys) for c in df.columns])


def _pick(c: str, keys: Sequence[str]) -> Column:
    return F.col(c) if c in keys else F.col(f"newest.{c}").alias(c)


def merge_changes(
    ods: DataFrame,
    spec: TableSpec,
    rules: dict[str, Column] | None = None,
    etl_time: str | None = None,
    dt: str | None = None,
    scope: str = "dt",
    delete_mode: str = "filter",
    null_op: str = "drop",
) -> DataFrame:
    """Live detail rows of a change log.

    ``scope``: ``"dt"`` ranks within each partition, ``"all"`` over the whole log.
    ``delete_mode``: ``"filter"`` removes delete rows first, so the last version before a
    delete survives; ``"tombstone"`` ranks first and drops keys whose last change is a delete.
    ``null_op``: rows without a change type (full imports) are dropped or kept.
    """
    if dt is not None:
        ods = ods.filter(F.col("dt") == dt)
    return live_rows(newest_changes(ods, spec, scope, delete_mode, null_op), spec, rules, etl_time)


def _live() -> Column:
    return F.col("op_type").isNull() | (F.col("op_type") != DELETE)


def newest_changes(ods: DataFrame, spec: TableSpec, scope: str = "dt", delete_mode: str = "filter", null_op: str = "drop") -> DataFrame:
    """The latest change of each key, with its order marks; with ``"tombstone"`` also deletes.

    It can be folded: the newest of the newest changes of parts of a log are those of the whole log.
    """
    _one_of("scope", scope, ("dt", "all"))
    _one_of("delete_mode", delete_mode, ("filter", "tombstone"))
    _one_of("null_op", null_op, ("drop", "keep"))
    if null_op == "drop":
        ods = ods.filter(F.col("op_type").isNotNull())
    if delete_mode == "filter":
        ods = ods.filter(_live())
    order_by = [c for c in ORDER_COLUMNS if c in ods.columns]
    # The key first: its values differ early, which makes the sort before the aggregate cheap.
    keys = [spec.key, "dt"] if scope == "dt" else [spec.key]
    needed = dict.fromkeys([*keys, *order_by, *spec.detail_columns, "op_type", "dt"])
    return latest_rows(ods.select(*needed), keys, order_by)


def live_rows(newest: DataFrame, spec: TableSpec, rules: dict[str, Column] | None = None, etl_time: str | None = None) -> DataFrame:
    """Detail rows of the latest changes, without deleted keys."""
    rules = rules or {}
    return newest.filter(_live()).select(
        *[rules.get(c, F.col(c)).alias(c) for c in spec.detail_columns],
        F.lit(DATA_SOURCE).alias("data_source"),
        load_time(etl_time).alias("etl_time"),
        "dt",
    )


def merge_rules(table: str) -> dict[str, Column]:
    """Value rules of the change-log route: no trimming, and a NULL amount stays NULL."""
    return {
        PRODUCT.name: {"price": non_negative("price")},
        ORDER.name: {
            "total_amount": non_negative("total_amount"),
            "order_status": checked_status("order_status"),
        },
    }.get(table, {})


def merge_table(ods: DataFrame, table: str = USER.name, **options) -> DataFrame:
    """``merge_changes`` with the shape and rules of a known table."""
    return merge_changes(ods, SOURCE_TABLES[table], merge_rules(table), **options)


def _one_of(name: str, value: str, allowed: Sequence[str]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {tuple(allowed)}, got {value!r}")
