"""Replayed streams: micro-batches of several files, rows at the edge of a watermark."""

import datetime

from pyspark.sql import functions as F

from harness.compare import compare, connect
from harness.spark_queries import _run_batches
from layerloom.session import scratch_path
from layerloom.sources.topics import stream_files
from layerloom.streaming.cdc import parse_spread


def test_repeats_of_the_last_minute_before_the_split_are_dropped(spark, tmp_path):
    start = datetime.datetime(2024, 1, 14, 23, 55)
    rows = [(i, start + datetime.timedelta(seconds=6 * i + 1), 1.25) for i in range(100)]  # ids 40 and 50: the minutes before and after midnight
    frame = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, value double")
    frame.coalesce(1).write.parquet(str(tmp_path / "written"))
    next((tmp_path / "written").glob("*.parquet")).rename(tmp_path / "events.parquet")
    assert compare(spark, connect(str(tmp_path)), str(tmp_path), "minute_orders_late") == []


def test_a_part_of_several_files_is_one_batch(spark):
    seen, checkpoint = [], scratch_path(spark, "checkpoint")

    def start(part):
        writer = part.writeStream.foreachBatch(lambda batch, n: seen.append((n, batch.count())))
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    _run_batches(spark, [spark.range(0, 60, 1, 4), spark.range(60, 100, 1, 3)], start)
    assert seen == [(0, 60), (1, 40)]


def test_one_file_of_messages_is_parsed_by_several_tasks(spark, tmp_path):
    message = '{"database":"demo_oltp","table":"u_user","type":"INSERT","ts":1,"data":[{"user_id":"1"}]}'
    spark.range(1000).select(F.lit(message).alias("value")).coalesce(1).write.text(str(tmp_path / "in"))
    seen = []

    def on_batch(batch, n):
        parsed = parse_spread(batch)
        seen.extend(r["count"] for r in parsed.groupBy(F.spark_partition_id()).count().collect())
        parsed.unpersist()

    writer = stream_files(spark, str(tmp_path / "in")).writeStream.foreachBatch(on_batch)
    writer.option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert sum(seen) == 1000 and len(seen) > 1 and max(seen) <= 500
