"""Batch cleansing from the raw to the detail layer: one narrow pass, no shuffle.

Duplicates stay: removing them is the latest-row merge in ``operators.merge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.rules import checked_status, non_negative, non_null_key
from layerloom.functions.times import load_time, normalise_time
from layerloom.schemas import DATA_SOURCE, ORDER, ORDER_DETAIL, PRODUCT, USER, TableSpec


def _detail(ods: DataFrame, spec: TableSpec, rules: dict[str, Column], etl_time: str | None, dt: str | None) -> DataFrame:
    if dt is not None:
        ods = ods.filter(F.col("dt") == dt)
    columns = [rules.get(c, F.col(c)).alias(c) for c in spec.detail_columns]
    return ods.filter(non_null_key(spec.key)).select(
        *columns,
        F.lit(DATA_SOURCE).alias("data_source"),
        load_time(etl_time).alias("etl_time"),
        "dt",
    )


def clean_users(ods: DataFrame, etl_time: str | None = None, dt: str | None = None) -> DataFrame:
    rules = {"username": F.trim("username"), "register_time": normalise_time("register_time")}
    return _detail(ods, USER, rules, etl_time, dt)


def clean_products(ods: DataFrame, etl_time: str | None = None, dt: str | None = None) -> DataFrame:
    rules = {
        "product_name": F.trim("product_name"),
        "price": non_negative("price"),
        "create_time": normalise_time("create_time"),
    }
    return _detail(ods, PRODUCT, rules, etl_time, dt)


def clean_orders(ods: DataFrame, etl_time: str | None = None, dt: str | None = None) -> DataFrame:
    rules = {
        "total_amount": non_negative("total_amount", null_to_zero=True),
        "order_status": checked_status("order_status"),
        "create_time": normalise_time("create_time"),
    }
    return _detail(ods, ORDER, rules, etl_time, dt)


def clean_order_details(ods: DataFrame, etl_time: str | None = None, dt: str | None = None) -> DataFrame:
    """Column mapping only: the batch route declares no rules for this table."""
    return _detail(ods, ORDER_DETAIL, {}, etl_time, dt)


CLEANERS = {
    USER.name: clean_users,
    PRODUCT.name: clean_products,
    ORDER.name: clean_orders,
}
