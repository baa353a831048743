"""Daily topic metrics, for given days or for every day of the input at once.

Conditional distinct counts are taken from one row per (day, key) carrying flags: a
``COUNT(DISTINCT CASE ...)`` per metric would copy every input row once per expression. Both
aggregation levels combine on the map side, so neither a hot day nor a hot key gathers its
rows in one task. Cumulative counts for many days come from the first day each key is seen
and a running sum over the per-day totals; only that frame of one row per calendar day is
processed without partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.functions.numbers import average_price, cents, from_cents, half_up_ratio
from layerloom.functions.times import day_of, hour_of, load_time
from layerloom.params import check_dt

AMOUNT, RATE = "decimal(16,2)", "decimal(5,4)"

# Counted order state, evening and working hours, high price.
VALID_STATUS = 1
NIGHT_HOURS = (18, 23)
WORK_HOURS = (9, 18)
HIGH_PRICE = 100


def _given_days(df: DataFrame, dates: Sequence[str] | None) -> list[DataFrame]:
    """The asked days, so that a day without rows is reported too."""
    if dates is None:
        return []
    literals = F.array(*[F.lit(check_dt(d)).cast("date") for d in sorted(set(dates))])
    days = df.sparkSession.range(1).select(F.explode(literals).alias("day"))
    return [days.withColumn("reported", F.lit(1))]


def _only(df: DataFrame, dates: Sequence[str] | None) -> DataFrame:
    return df if dates is None else df.filter(F.col("dt").isin(*dates))


def _until(df: DataFrame, dates: Sequence[str] | None) -> DataFrame:
    return df if dates is None else df.filter(F.col("dt") <= max(dates))


def _asked(dates: Sequence[str] | None) -> Column:
    """Whether ``day`` is reported: other days need no per-key rows of their own."""
    return F.lit(True) if dates is None else F.col("day").isin(*[F.lit(d).cast("date") for d in dates])


def _with_day(df: DataFrame) -> DataFrame:
    """Adds ``dt`` as a DATE: unlike text it fits the fixed-width aggregation buffer."""
    return df.withColumn("day", F.col("dt").try_cast("date")).filter("day is not null")


def _sum_by_day(parts: Sequence[DataFrame], running: Sequence[str] = ()) -> DataFrame:
    """Add up per-day parts, each with some of the columns.

    ``running`` columns become running totals. Days without a ``reported`` row only feed the
    totals and are left out.
    """
    columns = list(dict.fromkeys(c for p in parts for c in p.columns if c != "day"))
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    per_day = joined.groupBy("day").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
    if running:
        so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        per_day = per_day.select(
            *[F.sum(c).over(so_far).alias(c) if c in running else F.col(c) for c in per_day.columns]
        )
    return per_day.filter("reported > 0")


def _report(per_day: DataFrame, metrics: dict[str, Column], etl_time: str | None) -> DataFrame:
    columns = [c.alias(name) for name, c in metrics.items()]
    return per_day.select(*columns, load_time(etl_time).alias("etl_time"), F.col("day").cast("string").alias("dt"))


def _flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is NULL)."""
    return F.when(condition, 1).otherwise(0)


def _distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).select("day", key).distinct()


def _part(day: str, when: Column | None = None, **counts: Column) -> Column:
    """One contribution to the metrics of ``day``, or to none."""
    at = F.col(day) if when is None else F.when(when, F.col(day))
    return F.struct(at.alias("day"), *[c.alias(name) for name, c in counts.items()])


def _by_key_and_day(
    kept: DataFrame, key: str, least: Sequence[str], parts: Sequence[Column], *counted: Column
) -> DataFrame:
    """Contributions of a frame with one row per key and day.

    ``least`` columns become their minimum over the key; ``first`` marks one row per key, so
    that what a key adds once is added once. Parts that count for nothing are left out.
    """
    of_key = Window.partitionBy(key)
    keyed = kept.select(
        "*",
        *[F.min(c).over(of_key).alias(f"__{c}") for c in least],
        (F.row_number().over(of_key.orderBy("made")) == 1).alias("first"),
    ).drop(*least)
    keyed = keyed.withColumnsRenamed({f"__{c}": c for c in least})
    added = keyed.select(F.explode(F.array(*parts)).alias("p")).select("p.*").filter("day is not null")
    return added.filter(reduce(lambda a, b: a | b, counted))


def order_daily_stats(
    dwd_order: DataFrame,
    dates: Sequence[str] | None = None,
    etl_time: str | None = None,
    valid_status: int = VALID_STATUS,
) -> DataFrame:
    """Orders, amount, average, valid and evening shares, amount per user of each day.

    Amounts of repeated order ids are all added; counts take each id once.
    """
    orders = _with_day(_only(dwd_order, dates))
    flags = orders.select(
        "day",
        "order_id",
        cents("total_amount").alias("amount"),
        _flag(F.col("order_status") == valid_status).alias("valid"),
        _flag(hour_of("create_time").between(*NIGHT_HOURS)).alias("night"),
    )
    per_order = flags.groupBy("day", "order_id").agg(
        F.sum("amount").alias("amount"), F.max("valid").alias("valid"), F.max("night").alias("night")
    )
    known = F.col("order_id").isNotNull()
    order_part = per_order.select(
        "day",
        F.lit(1).alias("reported"),
        "amount",
        _flag(F.col("amount").isNotNull()).alias("with_amount"),
        _flag(known).alias("orders"),
        _flag(known & (F.col("valid") == 1)).alias("valid"),
        _flag(known & (F.col("night") == 1)).alias("night"),
    )
    user_part = _distinct_keys(orders, "user_id").select("day", F.lit(1).alias("users"))
    per_day = _sum_by_day([order_part, user_part, *_given_days(dwd_order, dates)])
    orders_n, users = F.col("orders"), F.col("users")
    # A day whose amounts are all missing has the amount 0 but no average.
    amount = F.when(F.col("with_amount") > 0, F.col("amount"))
    return _report(
        per_day,
        {
            "total_order_count": orders_n,
            "total_order_amount": from_cents(F.col("amount"), AMOUNT),
            "avg_order_amount": half_up_ratio(amount, orders_n, 2, AMOUNT, num_scale=2),
            "valid_order_count": F.col("valid"),
            "valid_order_rate": half_up_ratio(F.col("valid"), orders_n, 4, RATE),
            "night_order_rate": half_up_ratio(F.col("night"), orders_n, 4, RATE),
            "per_user_amount": half_up_ratio(amount, users, 2, AMOUNT, num_scale=2),
        },
        etl_time,
    )


def user_daily_stats(
    dwd_user: DataFrame, dates: Sequence[str] | None = None, etl_time: str | None = None
) -> DataFrame:
    """New users, users so far, and the share of new users registered in working hours."""
    rows = _with_day(_until(dwd_user, dates))
    users = rows.filter("user_id is not null")
    made = day_of("register_time")
    in_time = F.col("day") <= made
    at_work = in_time & hour_of("register_time").between(*WORK_HOURS)
    # One row per user and day of registration, with all that the metrics need: one scan.
    kept = users.groupBy("user_id", made.alias("made")).agg(
        F.min("day").alias("seen"), F.max(_flag(in_time)).alias("new"), F.max(_flag(at_work)).alias("work")
    )
    zero, one = F.lit(0), F.lit(1)
    parts = [
        _part("made", total=zero, new=F.col("new"), work=F.col("work")),
        _part("seen", F.col("first"), total=one, new=zero, work=zero),
    ]
    counts = _by_key_and_day(kept, "user_id", ["seen"], parts, F.col("total") > 0, (F.col("new") > 0) & _asked(dates))
    days = _given_days(dwd_user, dates) or [rows.select("day").distinct().withColumn("reported", F.lit(1))]
    per_day = _sum_by_day([counts, *days], running=["total"])
    return _report(
        per_day,
        {
            "new_user_count": F.col("new"),
            "total_user_count": F.col("total"),
            "workhour_register_rate": half_up_ratio(F.col("work"), F.col("new"), 4, RATE),
        },
        etl_time,
    )


def product_daily_stats(
    dwd_product: DataFrame, dates: Sequence[str] | None = None, etl_time: str | None = None
) -> DataFrame:
    """Products so far, average price, share of high-priced products, new products.

    The average weighs every row of the history, so a product counts once per snapshot.
    """
    rows = _with_day(_until(dwd_product, dates))
    products = rows.filter("product_id is not null")
    high_day = F.when(F.col("price") >= HIGH_PRICE, F.col("day"))
    made = day_of("create_time")
    kept = products.groupBy("product_id", made.alias("made")).agg(
        F.min("day").alias("seen"), F.min(high_day).alias("dear"), F.max(_flag(F.col("day") <= made)).alias("new")
    )
    zero, one = F.lit(0), F.lit(1)
    parts = [
        _part("made", total=zero, high=zero, new=F.col("new")),
        _part("seen", F.col("first"), total=one, high=zero, new=zero),
        _part("dear", F.col("first"), total=zero, high=one, new=zero),
    ]
    cumulative = (F.col("total") > 0) | (F.col("high") > 0)
    counts = _by_key_and_day(kept, "product_id", ["seen", "dear"], parts, cumulative, (F.col("new") > 0) & _asked(dates))
    # The days of the history are those that have prices: this reads two columns again.
    prices = rows.groupBy("day").agg(F.sum(cents("price")).alias("price_cents"), F.count("price").alias("priced"))
    if dates is None:
        prices = prices.withColumn("reported", F.lit(1))
    per_day = _sum_by_day(
        [counts, prices, *_given_days(dwd_product, dates)], running=["total", "high", "price_cents", "priced"]
    )
    total = F.col("total")
    average = average_price(F.col("price_cents"), F.col("priced"))
    return _report(
        per_day,
        {
            "total_product_count": total,
            "avg_product_price": F.when(total == 0, F.lit(0).cast("decimal(10,2)")).otherwise(average),
            "high_price_rate": half_up_ratio(F.col("high"), total, 4, RATE),
            "new_product_count": F.col("new"),
        },
        etl_time,
    )


def _registered_today() -> Column:
    return day_of("register_time") == F.col("day")


def user_order_daily_stats(
    dwd_user: DataFrame,
    dwd_order: DataFrame,
    dates: Sequence[str] | None = None,
    etl_time: str | None = None,
) -> DataFrame:
    """Ordering users of each day and their share of its active users.

    Active are the ordering users and the users registered that day. Every ordering user is
    active, so one flag per (day, user) answers both counts and no join is needed. Without
    ``dates`` the days are those of both inputs; a row of no active user only names its day.
    """
    ordering = _with_day(_only(dwd_order, dates)).select("day", "user_id", F.lit(1).alias("ordering"))
    registered = F.when(_registered_today(), F.col("user_id")).alias("user_id")
    joined = _with_day(_only(dwd_user, dates)).select("day", registered, F.lit(0).alias("ordering"))
    per_user = ordering.unionByName(joined).groupBy("day", "user_id").agg(F.max("ordering").alias("ordering"))
    known = F.col("user_id").isNotNull()
    part = per_user.select(
        "day",
        F.lit(1).alias("reported"),
        _flag(known & (F.col("ordering") == 1)).alias("ordering"),
        _flag(known).alias("active"),
    )
    per_day = _sum_by_day([part, *_given_days(dwd_order, dates)])
    return _report(
        per_day,
        {
            "order_user_count": F.col("ordering"),
            "order_user_rate": half_up_ratio(F.col("ordering"), F.col("active"), 4, RATE),
        },
        etl_time,
    )


def active_user_orders(
    dwd_user: DataFrame, dwd_order: DataFrame, dates: Sequence[str] | None = None
) -> DataFrame:
    """Active users of each day left-joined to what they ordered that day.

    Users without an order have NULLs. The join is one aggregation per (day, user): a user is
    active through an order or a registration, so both sides only have to be added up. An
    unknown user counts as active but matches no order, as in an equi-join.
    """
    orders = _with_day(_only(dwd_order, dates)).select(
        "day", "user_id", F.lit(1).alias("order_rows"), cents("total_amount").alias("amount")
    )
    registered = _with_day(_only(dwd_user, dates)).filter(_registered_today()).select("day", "user_id")
    active = orders.unionByName(registered, allowMissingColumns=True).groupBy("day", "user_id")
    added = active.agg(F.sum("order_rows").alias("order_rows"), F.sum("amount").alias("amount"))
    known = F.col("user_id").isNotNull()
    return added.select(
        "user_id",
        F.when(known, F.col("order_rows")).alias("order_rows"),
        F.when(known, from_cents(F.col("amount"), AMOUNT)).alias("order_amount"),
        F.col("day").cast("string").alias("dt"),
    )
