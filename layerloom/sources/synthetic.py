"""Seeded sample data of the four source tables, generated in parallel by Spark.

Random values are hashes of seed and row id, not ``rand``: they do not depend on how rows are
partitioned, so a recomputed task gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.functions.times import time_text
from layerloom.operators.rollup import details_at_order_time, order_amounts

# Default row counts, and the share of rows updated later.
USERS, PRODUCTS, ORDERS, DETAILS = 1000, 500, 5000, 15000
UPDATED = {"u_user": 0.10, "p_product": 0.15, "o_order": 0.20, "o_order_detail": 0.05}


class _Draws:
    """Independent seeded random columns of the rows identified by ``key``."""

    def __init__(self, seed: int, key: str):
        self.seed = seed
        self.key = key
        self.used = 0

    def unit(self) -> Column:
        """A number in [0, 1)."""
        self.used += 1
        hashed = F.xxhash64(F.lit(self.seed), F.lit(self.key), F.lit(self.used), F.col(self.key))
        return F.pmod(hashed, F.lit(2**31)) / F.lit(2**31)

    def whole(self, low: int, high: int) -> Column:
        """A whole number in ``low..high``."""
        return (F.floor(self.unit() * (high - low + 1)) + low).cast("int")

    def money(self, low: float, high: float) -> Column:
        return F.round(self.unit() * (high - low) + low, 2).cast("decimal(10,2)")


def _ids(spark: SparkSession, n: int, name: str) -> DataFrame:
    return spark.range(1, n + 1).select(F.col("id").cast("int").alias(name))


def _day(dt: str) -> Column:
    return F.lit(dt).cast("date")


def _midnight(day: Column) -> Column:
    return time_text(day.cast("timestamp_ntz"))


def random_tables(
    spark: SparkSession,
    dt: str,
    seed: int = 0,
    users: int = USERS,
    products: int = PRODUCTS,
    orders: int = ORDERS,
    details: int = DETAILS,
) -> dict[str, DataFrame]:
    """The simple set: random names and amounts, times at midnight, nothing updated."""
    draw = _Draws(seed, "user_id")
    user = _ids(spark, users, "user_id").select(
        "user_id",
        F.concat(F.lit("user_"), draw.whole(0, 9999)).alias("username"),
        _midnight(F.date_sub(_day(dt), draw.whole(0, 364))).alias("register_time"),
    )
    draw = _Draws(seed, "product_id")
    product = _ids(spark, products, "product_id").select(
        "product_id",
        F.concat(F.lit("product_"), draw.whole(0, 999)).alias("product_name"),
        draw.money(0, 1000).alias("price"),
        _midnight(F.date_sub(_day(dt), draw.whole(0, 29))).alias("create_time"),
    )
    draw = _Draws(seed, "order_id")
    order = _ids(spark, orders, "order_id").select(
        "order_id",
        draw.whole(1, users).alias("user_id"),
        draw.money(0, 5000).alias("total_amount"),
        draw.whole(1, 3).cast("tinyint").alias("order_status"),
        _midnight(_day(dt)).alias("create_time"),
    )
    draw = _Draws(seed, "detail_id")
    detail = _ids(spark, details, "detail_id").select(
        "detail_id",
        draw.whole(1, orders).alias("order_id"),
        draw.whole(1, products).alias("product_id"),
        draw.whole(1, 10).alias("quantity"),
        _midnight(_day(dt)).alias("create_time"),
    )
    tables = {"u_user": user, "p_product": product, "o_order": order, "o_order_detail": detail}
    return {
        name: df.withColumn("update_time", F.col("register_time" if name == "u_user" else "create_time"))
        for name, df in tables.items()
    }


def _later(draw: _Draws, time: str, end: Column, share: float) -> Column:
    """``time``, or for a share of the rows a time between it and ``end``."""
    start = F.col(time).cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", start, end)
    moved = F.timestamp_add("SECOND", F.floor(draw.unit() * seconds).cast("bigint"), start)
    return F.when(draw.unit() < share, time_text(moved)).otherwise(F.col(time))


def updated_tables(
    spark: SparkSession,
    dt: str,
    seed: int = 0,
    users: int = USERS,
    products: int = PRODUCTS,
    orders: int = ORDERS,
    details: int = DETAILS,
    history_days: int = 365,
) -> dict[str, DataFrame]:
    """The consistent set: some rows updated later, all orders on ``dt``, detail times taken
    from the order, and order amounts rolled up from the details."""
    end = F.timestamp_add("SECOND", F.lit(86_399), _day(dt).cast("timestamp_ntz"))

    def past(draw: _Draws) -> Column:
        day = F.date_sub(_day(dt), draw.whole(0, history_days - 1)).cast("timestamp_ntz")
        return time_text(F.timestamp_add("SECOND", draw.whole(0, 86_399), day))

    def today(draw: _Draws) -> Column:
        return time_text(F.timestamp_add("SECOND", draw.whole(0, 86_399), _day(dt).cast("timestamp_ntz")))

    draw = _Draws(seed, "user_id")
    user = _ids(spark, users, "user_id").select(
        "user_id", F.format_string("user_%04d", "user_id").alias("username"), past(draw).alias("register_time")
    )
    user = user.withColumn("update_time", _later(draw, "register_time", end, UPDATED["u_user"]))
    draw = _Draws(seed, "product_id")
    product = _ids(spark, products, "product_id").select(
        "product_id",
        F.format_string("product_%03d", "product_id").alias("product_name"),
        draw.money(10, 1000).alias("price"),
        past(draw).alias("create_time"),
    )
    product = product.withColumn("update_time", _later(draw, "create_time", end, UPDATED["p_product"]))
    draw = _Draws(seed, "order_id")
    order = _ids(spark, orders, "order_id").select(
        "order_id",
        draw.whole(1, users).alias("user_id"),
        draw.whole(1, 3).cast("tinyint").alias("order_status"),
        today(draw).alias("create_time"),
    )
    order = order.withColumn("update_time", _later(draw, "create_time", end, UPDATED["o_order"]))
    draw = _Draws(seed, "detail_id")
    detail = _ids(spark, details, "detail_id").select(
        "detail_id",
        draw.whole(1, orders).alias("order_id"),
        draw.whole(1, products).alias("product_id"),
        draw.whole(1, 5).alias("quantity"),
        F.lit(None).cast("string").alias("create_time"),
    )
    detail = details_at_order_time(detail, order)
    detail = detail.withColumn("update_time", _later(draw, "create_time", end, UPDATED["o_order_detail"]))
    amounts = order_amounts(detail, product).select("order_id", "order_amount")
    total = F.coalesce(F.col("order_amount"), F.lit(0)).cast("decimal(10,2)").alias("total_amount")
    order = order.join(amounts, "order_id", "left").select(
        "order_id", "user_id", total, "order_status", "create_time", "update_time"
    )
    detail = detail.select("detail_id", "order_id", "product_id", "quantity", "create_time", "update_time")
    return {"u_user": user, "p_product": product, "o_order": order, "o_order_detail": detail}
