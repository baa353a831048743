"""Order amounts rolled up from order details, and their comparison with the order table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.functions.numbers import cents, from_cents


_DAY, _NONE = 1 << 40, 1 << 36


def latest_prices(products: DataFrame) -> DataFrame:
    """``product_id, price`` of each product's latest ``dt``; without ``dt``, rows as they are.

    Day and cents are packed into one BIGINT, whose maximum stays in the hash aggregate.
    """
    if "dt" not in products.columns:
        return products.select("product_id", "price")
    day = F.coalesce(F.unix_date(F.col("dt").try_cast("date")).cast("bigint"), F.lit(0))
    packed = day * _DAY + F.coalesce(cents("price") + _NONE, F.lit(0))
    low = F.pmod(F.max(packed), F.lit(_DAY))
    price = F.when(low != 0, from_cents(low - _NONE)).cast("decimal(10,2)")
    return products.groupBy("product_id").agg(price.alias("price"))


def price_details(details: DataFrame, products: DataFrame) -> DataFrame:
    """Details with ``price`` and ``detail_amount = round(price * quantity, 2)``.

    Of several rows of a product, such as daily snapshots, the one with the latest ``dt`` counts
    (the greatest price of that day). No broadcast hint: Spark broadcasts the products only when their measured size is under
    its threshold, and splits a hot product of a sort-merge join at run time.
    """
    priced = details.join(latest_prices(products), "product_id")
    amount = F.round(F.col("price") * F.col("quantity"), 2).cast("decimal(16,2)")
    return priced.withColumn("detail_amount", amount)


def details_at_order_time(details: DataFrame, orders: DataFrame) -> DataFrame:
    """Details that take ``create_time`` from their order."""
    times = orders.select("order_id", "create_time")
    return details.drop("create_time").join(times, "order_id")


def order_amounts(details: DataFrame, products: DataFrame) -> DataFrame:
    """``(order_id, detail_count, order_amount)``."""
    priced = price_details(details, products)
    sums = priced.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("detail_count"),
        F.sum(cents("detail_amount")).alias("amount_cents"),
    )
    return sums.select("order_id", "detail_count", from_cents(F.col("amount_cents")).alias("order_amount"))


def amount_differences(orders: DataFrame, details: DataFrame, products: DataFrame) -> DataFrame:
    """Every order id of either side with both amounts and their difference.

    Booked and detail amounts are added up per order id in one aggregation, which is a full
    outer join of the two sums without sorting either side. A missing side has a NULL amount
    and counts as 0 in the difference; amounts of repeated order ids are added.
    """
    booked = orders.select("order_id", cents("total_amount").alias("booked"))
    rolled = price_details(details, products)
    rolled = rolled.select("order_id", cents("detail_amount").alias("rolled"))
    both = booked.unionByName(rolled, allowMissingColumns=True).groupBy("order_id")
    sums = both.agg(F.sum("booked").alias("booked"), F.sum("rolled").alias("rolled"))
    difference = F.coalesce("booked", F.lit(0)) - F.coalesce("rolled", F.lit(0))
    return sums.select(
        "order_id",
        from_cents(F.col("booked")).alias("total_amount"),
        from_cents(F.col("rolled")).alias("order_amount"),
        from_cents(difference).alias("difference"),
    )
