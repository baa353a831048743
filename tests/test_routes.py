"""One raw layout for all routes, owners of detail tables, and windows that are read again."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from layerloom.operators import metrics
from layerloom.params import now_text
from layerloom.plans import daily
from layerloom.schemas import USER
from layerloom.session import scratch_path
from layerloom.sinks import loads
from layerloom.sinks.tables import RouteConflict, overwrite_partition, partition_days
from layerloom.sources.relational import spread_predicates
from layerloom.streaming import cdc
from tests.test_scale import plan
from tests.test_streaming import BATCHES, user_event

DT = "2024-01-01"
SOURCE = "user_id int, username string, register_time string, update_time string"


@pytest.fixture
def users(spark):
    rows = [(i, f"u{i}", f"{DT} 08:00:00", f"{DT} 1{i}:00:00") for i in range(4)]
    return {"u_user": spark.createDataFrame(rows, SOURCE)}


def batch(spark, n):
    return spark.createDataFrame([(line,) for line in BATCHES[n]], "value string")


@pytest.mark.parametrize("stream_first", [True, False])
def test_both_routes_share_raw_tables(spark, users, stream_first):
    root = scratch_path(spark, "routes")
    house, job = daily.Warehouse(spark, root), cdc.CdcJob(root, tables=("u_user",), etl_time="now")
    steps = [lambda: cdc.apply_batch(batch(spark, 0), job, "q-0"), lambda: daily.import_day(house, users, DT)]
    for step in steps if stream_first else steps[::-1]:
        step()
    cdc.apply_batch(batch(spark, 1), job, "q-1")
    log = cdc.read_change_log(spark, job, USER)
    assert {r["load"]: r["n"] for r in log.groupBy("load").agg(F.count("*").alias("n")).collect()} == {"full": 4, "q-0": 2, "q-1": 2}
    assert house.ods("u_user", [DT]).count() == 4
    names = {r.username for r in spark.read.parquet(job.dwd_path(USER)).collect()}
    assert names == {"a2", "b1", "c1"}


def test_a_detail_table_has_one_owner(spark, users):
    root = scratch_path(spark, "owner")
    house, job = daily.Warehouse(spark, root), cdc.CdcJob(root, tables=("u_user",))
    daily.import_day(house, users, DT)
    cdc.apply_batch(batch(spark, 0), job, "q-0")
    with pytest.raises(RouteConflict, match="stream"):
        daily.clean_day(house, DT, "now")
    other = scratch_path(spark, "owner")
    house = daily.Warehouse(spark, other)
    daily.import_day(house, users, DT)
    daily.clean_day(house, DT, "now")
    with pytest.raises(RouteConflict, match="batch"):
        cdc.apply_batch(batch(spark, 0), cdc.CdcJob(other, tables=("u_user",)), "q-0")


def test_a_window_that_is_read_again_is_there_once(spark, users):
    house = daily.Warehouse(spark, scratch_path(spark, "again"))
    daily.import_changes(house, users, DT, f"{DT} 12:00:00")
    assert house.ods("u_user").count() == 2
    lost = daily.Warehouse(spark, house.root, mark_folder="lost")
    daily.import_changes(lost, users, "2024-01-02", f"{DT} 13:00:00")
    assert house.ods("u_user").count() == 3
    assert [(x.dt, x.name, x.number) for x in loads.published(spark, house.ods_path("u_user"))] == [("2024-01-02", "since_19700101000000", 2)]
    assert os.listdir(f"{house.ods_path('u_user')}/dt={DT}") == ["_SUCCESS"] or not any("load=" in n for n in os.listdir(f"{house.ods_path('u_user')}/dt={DT}"))
    assert house.marks.current("u_user") == f"{DT} 12:00:00"


def test_the_clock_does_not_follow_the_drivers_zone():
    code = "import json; from layerloom.params import now_text, run_dt; print(json.dumps([now_text(), run_dt()]))"
    seen = []
    for zone in ("Asia/Shanghai", "UTC", "America/Los_Angeles"):
        out = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": zone}, capture_output=True, text=True, check=True)
        seen.append(json.loads(out.stdout))
    assert len({t[0][:15] for t in seen}) <= 2 and len({t[1] for t in seen}) <= 2
    assert now_text(3600) < now_text()


def test_a_merge_drops_digests_of_its_days(spark):
    job = cdc.CdcJob(scratch_path(spark, "digests"), tables=("u_user",))
    folder = f"{job.root}/digests/u_user"
    for day in ("2023-12-31", "2024-01-01", "2024-01-05"):
        overwrite_partition(spark.createDataFrame([(1, day)], "user_id int, dt string"), folder, day)
    cdc.apply_batch(batch(spark, 0), job, "q-0")
    assert partition_days(spark, folder) == ["2023-12-31"]


def test_configured_streams_keep_all_rows_and_bad_events(spark, tmp_path):
    from layerloom.sources.field_list import read_configs
    from layerloom.sources.topics import stream_files
    from tests.test_streaming import put

    two = json.loads(user_event(1, "a"))
    two["data"] *= 2
    put(tmp_path / "in", 0, [json.dumps(two), "broken {"])
    configs = read_configs(["u_user|changes|users|id:BIGINT(20):user_id"])
    root = scratch_path(spark, "configured")
    cdc.start_configured(stream_files(spark, str(tmp_path / "in")), configs, root, str(tmp_path / "ck"), {"availableNow": True}).awaitTermination()
    assert spark.read.parquet(f"{root}/users").count() == 2
    assert [r.reason for r in spark.read.parquet(f"{root}/bad_events").collect()] == ["unroutable"]


def test_the_run_date_is_that_of_the_batch(spark, monkeypatch):
    job = cdc.CdcJob(scratch_path(spark, "days"), tables=("u_user",), dt_policy="run_date", merge_each_batch=False)
    for n, day in enumerate(("2024-02-01", "2024-02-02")):
        monkeypatch.setattr(cdc, "run_dt", lambda day=day: day)
        cdc.apply_batch(batch(spark, n), job, f"q-{n}")
    assert partition_days(spark, job.ods_path(USER)) == ["2024-02-01", "2024-02-02"]


def test_one_scan_of_the_history(spark):
    rows = spark.createDataFrame([(1, "a", f"{DT} 08:00:00", DT)], "user_id int, username string, register_time string, dt string")
    path = scratch_path(spark, "users")
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    assert plan(metrics.user_daily_stats(stored, None, "now")).count("FileScan") == 2  # one is the day list
    house = daily.Warehouse(spark, scratch_path(spark, "house"))
    overwrite_partition(rows, house.dwd_path("u_user"), DT)
    assert plan(daily.day_metrics(house, [DT], "now")["dws_user_stats_di"]).count("FileScan") == 1


def test_spread_predicates_are_disjoint_and_complete(spark):
    rows = spark.createDataFrame([(i,) for i in (-7, -1, 0, 1, 2, 3, 1_000_000, None)], "user_id int")
    found = [rows.filter(p).count() for p in spread_predicates(USER, 3)]
    assert sum(found) == 8
