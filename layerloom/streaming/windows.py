"""Event-time windows over cleansed orders; the same function serves batch frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.functions.numbers import cents, from_cents

# Fixed value: how far events may arrive out of order.
WATERMARK = "5 seconds"


def with_event_time(events: DataFrame, ms_column: str = "ts", delay: str = WATERMARK) -> DataFrame:
    """Adds ``ts_ltz`` from epoch milliseconds and declares it as the event time."""
    return events.withColumn("ts_ltz", F.timestamp_millis(F.col(ms_column))).withWatermark("ts_ltz", delay)


def minute_order_stats(
    orders: DataFrame, event_time: str = "ts_ltz", width: str = "1 minute", with_users: bool = False
) -> DataFrame:
    """Order count and amount per tumbling window.

    ``orders`` carries a watermark on ``event_time`` when it is a stream; rows later than that
    are dropped, and in append mode a window is emitted once the watermark passes its end.
    ``with_users`` adds an approximate distinct user count: streams allow no exact one.
    """
    aggregates = [
        F.count(F.lit(1)).alias("order_count"),
        F.sum(cents("total_amount")).alias("amount"),
    ]
    if with_users:
        aggregates.append(F.approx_count_distinct("user_id").alias("approx_users"))
    grouped = orders.groupBy(F.window(event_time, width)).agg(*aggregates)
    users = ["approx_users"] if with_users else []
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "order_count",
        from_cents(F.coalesce("amount", F.lit(0))).alias("order_amount"),
        *users,
    )
