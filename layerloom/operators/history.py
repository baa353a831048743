"""Cumulative user and product metrics from per-key digests instead of the whole history.

A digest holds one row per key and creation day with values that can be merged (first day,
flags, sums). The digest of a day is the digest of an earlier day merged with the rows loaded
since, so a daily run reads as many rows as there are keys, not every snapshot ever loaded.
The metrics equal those of ``operators.metrics`` for that day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.numbers import average_price, cents, half_up_ratio
from layerloom.functions.times import day_of, hour_of, load_time
from layerloom.operators.metrics import HIGH_PRICE, RATE, WORK_HOURS
from layerloom.schemas import PRODUCT, USER

_MERGE = {"work": F.max, "high": F.max, "price_cents": F.sum, "priced": F.sum}


def _merged(df: DataFrame, key: str) -> DataFrame:
    values = [c for c in df.columns if c in _MERGE]
    return df.groupBy(key, "created").agg(*[_MERGE[c](c).alias(c) for c in values])


def user_digest(dwd_user: DataFrame) -> DataFrame:
    """``(user_id, created, work)``."""
    work = F.coalesce(hour_of("register_time").between(*WORK_HOURS), F.lit(False)).cast("int")
    rows = dwd_user.select("user_id", day_of("register_time").alias("created"), work.alias("work"))
    return _merged(rows.filter("user_id is not null"), "user_id")


def product_digest(dwd_product: DataFrame) -> DataFrame:
    """``(product_id, created, high, price_cents, priced)``; rows without a key only feed the average."""
    rows = dwd_product.select(
        "product_id",
        day_of("create_time").alias("created"),
        F.coalesce(F.col("price") >= HIGH_PRICE, F.lit(False)).cast("int").alias("high"),
        cents("price").alias("price_cents"),
        F.col("price").isNotNull().cast("bigint").alias("priced"),
    )
    return _merged(rows, "product_id")


def merge_digests(earlier: DataFrame, later: DataFrame, key: str) -> DataFrame:
    return _merged(earlier.unionByName(later), key)


def _one_row(per_key: DataFrame, key: str, sums: list[str]) -> DataFrame:
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]
    return per_key.agg(F.count(key).alias("total"), *totals)


def _on(dt: str) -> Column:
    return F.col("created") == F.lit(dt).cast("date")


def user_stats(digest: DataFrame, dt: str, etl_time: str | None = None) -> DataFrame:
    """The user metrics of ``dt`` from the digest of that day."""
    per_user = digest.groupBy("user_id").agg(
        F.max(F.when(_on(dt), 1).otherwise(0)).alias("new"),
        F.max(F.when(_on(dt), F.col("work")).otherwise(0)).alias("work"),
    )
    one = _one_row(per_user, "user_id", ["new", "work"])
    return one.select(
        F.col("new").alias("new_user_count"),
        F.col("total").alias("total_user_count"),
        half_up_ratio(F.col("work"), F.col("new"), 4, RATE).alias("workhour_register_rate"),
        load_time(etl_time).alias("etl_time"),
        F.lit(dt).alias("dt"),
    )


def product_stats(digest: DataFrame, dt: str, etl_time: str | None = None) -> DataFrame:
    """The product metrics of ``dt`` from the digest of that day."""
    known = F.col("product_id").isNotNull()
    per_product = digest.groupBy("product_id").agg(
        F.max(F.when(known & _on(dt), 1).otherwise(0)).alias("new"),
        F.max(F.when(known, F.col("high")).otherwise(0)).alias("high"),
        F.sum("price_cents").alias("price_cents"),
        F.sum("priced").alias("priced"),
    )
    one = _one_row(per_product, "product_id", ["new", "high", "price_cents", "priced"])
    total = F.col("total")
    average = average_price(F.col("price_cents"), F.col("priced"))
    return one.select(
        total.alias("total_product_count"),
        F.when(total == 0, F.lit(0).cast("decimal(10,2)")).otherwise(average).alias("avg_product_price"),
        half_up_ratio(F.col("high"), total, 4, RATE).alias("high_price_rate"),
        F.col("new").alias("new_product_count"),
        load_time(etl_time).alias("etl_time"),
        F.lit(dt).alias("dt"),
    )


DIGESTS = {USER.name: user_digest, PRODUCT.name: product_digest}
STATS = {USER.name: user_stats, PRODUCT.name: product_stats}

# Stored shape of the digests.
DIGEST_SCHEMAS = {
    USER.name: "user_id int, created date, work int",
    PRODUCT.name: "product_id int, created date, high int, price_cents bigint, priced bigint",
}
