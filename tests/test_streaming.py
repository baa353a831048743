import json
import os
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from layerloom.operators.changelog import flatten_table, parse_events
from layerloom.operators.merge import merge_table
from layerloom.schemas import ORDER, ORDER_DETAIL, USER
from layerloom.session import scratch_path
from layerloom.sinks.tables import read_partitions
from layerloom.sources.field_list import read_configs
from layerloom.sources.topics import stream_files
from layerloom.streaming import cdc
from layerloom.streaming.windows import minute_order_stats, with_event_time

DAY = 86_400_000
BASE = 1704067200000  # 2024-01-01 00:00:00


def user_event(i, name, kind="INSERT", ts=BASE, day="2024-01-01"):
    row = {"user_id": str(i), "username": name, "register_time": f"{day} 08:00:00", "update_time": f"{day} 09:00:00"}
    return json.dumps({"database": "demo_oltp", "table": "u_user", "type": kind, "ts": ts, "data": [row]})


def order_event(i, amount, kind="INSERT", ts=BASE):
    row = {"order_id": str(i), "user_id": "1", "total_amount": amount, "order_status": "7", "create_time": "2024-01-01 10:00:00"}
    return json.dumps({"database": "demo_oltp", "table": "o_order", "type": kind, "ts": ts, "data": [row]})


def detail_event(i, ts=BASE):
    row = {"detail_id": str(i), "order_id": "1", "product_id": "2", "quantity": "3", "create_time": "2024-01-01 10:00:00"}
    return json.dumps({"database": "demo_oltp", "table": "o_order_detail", "type": "INSERT", "ts": ts, "data": [row]})


BATCHES = [
    [user_event(1, "a1"), user_event(2, "b1"), order_event(1, "-5.00"), detail_event(1), "broken {"],
    [user_event(1, "a2", "UPDATE", BASE + 1000), user_event(3, "c1", ts=BASE + DAY, day="2024-01-02"), detail_event(2)],
    [user_event(2, "b2", "DELETE", BASE + 5000), user_event(3, "c2", "DELETE", BASE + DAY + 1, "2024-01-02")],
]


def put(folder, n, lines):
    folder.mkdir(exist_ok=True)
    path = folder / f"{n:03d}.txt"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def ingest(spark, folder, job, checkpoint):
    raw = stream_files(spark, str(folder), maxFilesPerTrigger="1")
    cdc.start_ingest(raw, job, checkpoint, {"availableNow": True}).awaitTermination()


def detail_rows(spark, job, spec, rows):
    df = read_partitions(spark, job.dwd_path(spec), spec.dwd_schema(), spec.detail_format)
    return rows(df.drop("data_source", "etl_time"))


@pytest.mark.parametrize("mode", ["filter", "tombstone"])
def test_stream_equals_batch(spark, rows, tmp_path, mode):
    for n, lines in enumerate(BATCHES):
        put(tmp_path / "in", n, lines)
    job = cdc.CdcJob(scratch_path(spark, "cdc"), etl_time="now", merge_options={"delete_mode": mode})
    ingest(spark, tmp_path / "in", job, str(tmp_path / "ck"))

    everything = spark.createDataFrame([(line,) for lines in BATCHES for line in lines], "value string")
    for spec in (USER, ORDER, ORDER_DETAIL):
        log = flatten_table(parse_events(everything), spec, keep_order=True)
        want = merge_table(log, spec.name, etl_time="now", delete_mode=mode)
        assert detail_rows(spark, job, spec, rows) == rows(want.drop("data_source", "etl_time"))
    names = {r[1] for r in detail_rows(spark, job, USER, rows)}
    assert names == ({"a2", "b1", "c1"} if mode == "filter" else {"a2"})
    assert detail_rows(spark, job, ORDER, rows) == [(1, 1, Decimal("0.00"), -1, "2024-01-01 10:00:00", "2024-01-01")]
    assert rows(spark.read.parquet(job.bad_path), "raw") == [("broken {",)]
    assert cdc.read_change_log(spark, job, USER).count() == 6
    assert Path(job.dwd_path(USER), "dt=2024-01-01", "_SUCCESS").exists()


def test_restart_goes_on_from_the_checkpoint(spark, rows, tmp_path):
    job = cdc.CdcJob(scratch_path(spark, "cdc"), tables=("u_user",))
    for n, lines in enumerate(BATCHES):
        put(tmp_path / "in", n, lines)
        ingest(spark, tmp_path / "in", job, str(tmp_path / "ck"))
    assert cdc.read_change_log(spark, job, USER).count() == 6
    loads = {r.load for r in cdc.read_change_log(spark, job, USER).select("load").distinct().collect()}
    assert len(loads) == 3
    assert all(len(load) > 36 for load in loads)  # a query id and a batch number
    ingest(spark, tmp_path / "in", job, str(tmp_path / "ck"))
    assert cdc.read_change_log(spark, job, USER).count() == 6


def test_a_repeated_batch_changes_nothing(spark, rows):
    job = cdc.CdcJob(scratch_path(spark, "cdc"), tables=("u_user",), etl_time="now")
    first = spark.createDataFrame([(line,) for line in BATCHES[0]], "value string")
    second = spark.createDataFrame([(line,) for line in BATCHES[1]], "value string")
    cdc.apply_batch(first, job, "q-0")
    cdc.apply_batch(second, job, "q-1")
    before = rows(cdc.read_change_log(spark, job, USER)), detail_rows(spark, job, USER, rows)
    cdc.apply_batch(second, job, "q-1")
    cdc.replay_day(spark, job, "2024-01-01")
    assert (rows(cdc.read_change_log(spark, job, USER)), detail_rows(spark, job, USER, rows)) == before


def test_merging_later_gives_the_same(spark, rows):
    later = cdc.CdcJob(scratch_path(spark, "cdc"), tables=("u_user",), etl_time="now", merge_each_batch=False)
    now = cdc.CdcJob(scratch_path(spark, "cdc"), tables=("u_user",), etl_time="now")
    for n, lines in enumerate(BATCHES):
        for job in (later, now):
            cdc.apply_batch(spark.createDataFrame([(line,) for line in lines], "value string"), job, f"q-{n}")
    assert detail_rows(spark, later, USER, rows) == []
    for dt in ("2024-01-01", "2024-01-02", "2024-01-03"):
        cdc.replay_day(spark, later, dt)
    assert detail_rows(spark, later, USER, rows) == detail_rows(spark, now, USER, rows) != []


def test_a_day_without_survivors_is_emptied(spark, rows):
    job = cdc.CdcJob(scratch_path(spark, "cdc"), tables=("u_user",), merge_options={"delete_mode": "tombstone"})
    for n, lines in enumerate(BATCHES):
        cdc.apply_batch(spark.createDataFrame([(line,) for line in lines], "value string"), job, f"q-{n}")
    assert {r[3] for r in detail_rows(spark, job, USER, rows)} == {"2024-01-01"}


def test_position_orders_changes_of_the_same_millisecond(spark, rows):
    job = cdc.CdcJob(scratch_path(spark, "cdc"), tables=("u_user",))
    raw = spark.createDataFrame(
        [(user_event(1, "early"), 0, 5), (user_event(1, "late"), 0, 10), (user_event(1, "middle"), 0, 9)],
        "value string, src_partition int, src_offset bigint",
    )
    cdc.apply_batch(raw, job, "q-0")
    assert detail_rows(spark, job, USER, rows) == [(1, "late", "2024-01-01 08:00:00", "2024-01-01")]


def test_a_stream_merge_works_on_days():
    with pytest.raises(ValueError):
        cdc.CdcJob("x", merge_options={"scope": "all"})


def test_append_only_stream(spark, rows, tmp_path):
    for n, lines in enumerate(BATCHES):
        put(tmp_path / "in", n, lines)
    path = scratch_path(spark, "append")
    for _ in range(2):
        raw = stream_files(spark, str(tmp_path / "in"))
        cdc.start_append(
            raw, USER, path, str(tmp_path / "ck"), {"availableNow": True}, dt_policy="op_date"
        ).awaitTermination()
    got = read_partitions(spark, path, USER.ods_schema())
    assert rows(got.groupBy("dt").count()) == [("2024-01-01", 4), ("2024-01-02", 2)]


def test_configured_tables(spark, rows, tmp_path):
    for n, lines in enumerate(BATCHES):
        put(tmp_path / "in", n, lines)
    configs = read_configs([
        "# skipped",
        "",
        "u_user|changes|my_users|id:INT:user_id,name:STRING:username",
        "o_order|changes|my_orders|id:BIGINT:order_id,amount:DECIMAL(12,1):total_amount",
    ])
    root = scratch_path(spark, "configured")
    for _ in range(2):
        raw = stream_files(spark, str(tmp_path / "in"))
        cdc.start_configured(raw, configs, root, str(tmp_path / "ck"), {"availableNow": True}).awaitTermination()
    users = spark.read.parquet(f"{root}/my_users")
    assert sorted(users.columns) == ["dt", "id", "load", "name", "op_ts", "op_type"]
    assert rows(users.select(F.col("dt").cast("string"), "id", "name", "op_type")) == [
        ("2024-01-01", 1, "a1", "INSERT"),
        ("2024-01-01", 1, "a2", "UPDATE"),
        ("2024-01-01", 2, "b1", "INSERT"),
        ("2024-01-01", 2, "b2", "DELETE"),
        ("2024-01-02", 3, "c1", "INSERT"),
        ("2024-01-02", 3, "c2", "DELETE"),
    ]
    assert rows(spark.read.parquet(f"{root}/my_orders"), "id", "amount") == [(1, Decimal("-5.0"))]


def order_lines(*seconds):
    return [json.dumps({"ts": BASE + int(s * 1000), "amount": 1.5}) for s in seconds]


def windows(spark, folder, path, checkpoint):
    raw = spark.readStream.schema("ts bigint, amount double").option("maxFilesPerTrigger", 1).json(str(folder))
    orders = with_event_time(raw).withColumn("total_amount", F.col("amount").cast("decimal(10,2)"))
    writer = minute_order_stats(orders).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return [tuple(r) for r in spark.read.parquet(path).orderBy("window_start").select(
        F.unix_seconds("window_start") - BASE // 1000, "order_count", "order_amount"
    ).collect()]


def test_minute_windows_drop_late_rows(spark, tmp_path):
    put(tmp_path / "in", 0, order_lines(1, 30, 61))
    put(tmp_path / "in", 1, order_lines(130, 59))  # 59 s is late by less than one batch: still in time
    put(tmp_path / "in", 2, order_lines(131))
    put(tmp_path / "in", 3, order_lines(2, 62, 190))  # two rows long past the watermark
    put(tmp_path / "in", 4, order_lines(200))
    got = windows(spark, tmp_path / "in", scratch_path(spark, "win"), str(tmp_path / "ck"))
    assert got == [(0, 3, Decimal("4.50")), (60, 1, Decimal("1.50")), (120, 2, Decimal("3.00"))]


def test_minute_windows_on_a_batch_frame(spark):
    df = spark.createDataFrame([(BASE + 1000, 1, Decimal("2.00")), (BASE + 2000, 1, None)], "ts bigint, user_id int, total_amount decimal(10,2)")
    (row,) = minute_order_stats(with_event_time(df), with_users=True).collect()
    assert (row.order_count, row.order_amount, row.approx_users) == (2, Decimal("2.00"), 1)
