"""Published loads: what readers see while loads are written, replaced and folded; imports of several days."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.operators.merge import merge_table
from layerloom.plans import daily
from layerloom.schemas import ORDER, USER
from layerloom.session import scratch_path
from layerloom.sinks import loads
from layerloom.streaming import cdc
from tests.test_streaming import BATCHES, detail_rows

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), *(T.StructField(n, T.StringType()) for n in ("name", "dt", "load"))])
D1, D2 = "2024-01-01", "2024-01-02"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, name string")


def stored(spark, path, rows, dts=None):
    return rows(loads.read_loads(spark, path, SCHEMA, dts))


def test_a_load_counts_once_it_is_published(spark, rows):
    path = scratch_path(spark, "loads")
    assert stored(spark, path, rows) == []
    first = loads.write_load(frame(spark, (1, "a")), path, D1, "full")
    assert stored(spark, path, rows) == [] and loads.published(spark, path) == []
    loads.publish(spark, path, [first])
    assert stored(spark, path, rows) == [(1, "a", D1, "full")]
    again = loads.write_load(frame(spark, (2, "b")), path, D1, "full")
    assert stored(spark, path, rows) == [(1, "a", D1, "full")]  # still readable
    gone = loads.publish(spark, path, [again], everywhere=False)
    assert stored(spark, path, rows) == [(2, "b", D1, "full")]
    assert gone == [first] and not os.path.exists(f"{path}/{first.folder}")


def test_a_failed_writer_leaves_nothing_that_counts(spark, rows):
    path = scratch_path(spark, "loads")
    loads.publish(spark, path, [loads.write_load(frame(spark, (1, "a")), path, D1, "since_1")])
    half = loads.write_load(frame(spark, (9, "half")), path, D2, "since_1")
    assert stored(spark, path, rows) == [(1, "a", D1, "since_1")]
    assert loads.next_number(spark, path, "since_1") == half.number + 1
    assert loads.remove_unpublished(spark, path) == [half]
    moved = loads.write_load(frame(spark, (1, "a"), (2, "b")), path, D2, "since_1")
    loads.publish(spark, path, [moved])  # the window was read again on another day
    assert stored(spark, path, rows) == [(1, "a", D2, "since_1"), (2, "b", D2, "since_1")]


def test_folded_loads_read_the_same_also_after_a_crash(spark, rows, monkeypatch):
    path = scratch_path(spark, "fold")
    for n in range(4):
        loads.publish(spark, path, [loads.write_load(frame(spark, (n, f"n{n}"), (n + 10, None)), path, D1, f"b-{n}")])
    loads.publish(spark, path, [loads.write_load(frame(spark, (99, "import")), path, D1, "full")])
    before = stored(spark, path, rows)
    wanted = lambda name: name != "full"
    monkeypatch.setattr(loads, "publish", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):  # written, not published
        loads.compact_day(spark, path, SCHEMA, D1, ["id"], wanted)
    assert stored(spark, path, rows) == before
    monkeypatch.undo()
    removing = loads.remove
    monkeypatch.setattr(loads, "remove", lambda spark, path, gone: list(gone))
    loads.compact_day(spark, path, SCHEMA, D1, ["id"], wanted)  # published, nothing removed
    assert stored(spark, path, rows) == before
    monkeypatch.setattr(loads, "remove", removing)
    loads.publish(spark, path, [loads.write_load(frame(spark, (0, "n0"), (10, None)), path, D1, "b-0")])
    assert stored(spark, path, rows) == before  # a folded batch that runs again is held already
    loads.publish(spark, path, [loads.write_load(frame(spark, (5, "late")), path, D1, "b-9")])
    assert loads.compact_day(spark, path, SCHEMA, D1, ["id"], wanted) is not None
    now = stored(spark, path, rows)
    assert now == sorted([*before, (5, "late", D1, "b-9")], key=repr)
    assert [x.name for x in loads.published(spark, path)] == ["compact", "full"]
    assert rows(loads.read_loads(spark, path, SCHEMA, None, lambda name: name == "b-2"), "id") == [(12,), (2,)]
    assert loads.compact_day(spark, path, SCHEMA, D2, ["id"]) is None


def test_a_fold_is_one_sorted_file_set(spark):
    path = scratch_path(spark, "fold")
    for n in range(3):
        loads.publish(spark, path, [loads.write_load(frame(spark, *[(i, "x") for i in range(n, 300, 3)]), path, D1, f"b-{n}")])
    folded = loads.compact_day(spark, path, SCHEMA, D1, ["id"])
    files = [f for f in os.listdir(f"{path}/{folded.folder}") if f.endswith(".parquet")]
    assert len(files) == 1
    ids = [r["id"] for r in spark.read.parquet(f"{path}/{folded.folder}/{files[0]}").collect()]
    assert ids == sorted(ids)


def lines(spark, n):
    return spark.createDataFrame([(line,) for line in BATCHES[n]], "value string")


@pytest.mark.parametrize("mode", ["filter", "tombstone"])
def test_a_batch_reads_its_rows_and_the_state(spark, rows, mode):
    job = cdc.CdcJob(scratch_path(spark, "state"), tables=("u_user",), etl_time="now", merge_options={"delete_mode": mode})
    for n in range(3):
        cdc.apply_batch(lines(spark, n), job, f"q-{n}")
    text = " ".join(cdc.changes_to_merge(spark, job, USER, [D1, D2], "q-2").inputFiles())
    assert "load=q-2@" in text and "load=state@" in text
    assert "load=q-0@" not in text and "load=q-1@" not in text
    want = merge_table(cdc.read_change_log(spark, job, USER), "u_user", etl_time="now", delete_mode=mode)
    assert detail_rows(spark, job, USER, rows) == rows(want.drop("data_source", "etl_time"))
    before = detail_rows(spark, job, USER, rows)
    cdc.compact_log(spark, job, D1)
    assert {x.name for x in loads.published(spark, job.ods_path(USER), [D1])} == {"compact"}
    assert cdc.read_change_log(spark, job, USER).count() == 6
    cdc.replay_day(spark, job, D1)
    assert detail_rows(spark, job, USER, rows) == before
    cdc.apply_batch(lines(spark, 2), job, "q-2")
    assert detail_rows(spark, job, USER, rows) == before


def orders(spark, *rows):
    names = "order_id int, user_id int, total_amount decimal(10,2), order_status int, create_time string, update_time string"
    return {"o_order": spark.createDataFrame([(i, 1, Decimal(a), 1, f"{D1} 10:00:00", f"{D1} {h}:00:00") for i, a, h in rows], names)}


def amounts(house, dt):
    return sorted((r["order_id"], str(r["total_amount"])) for r in house.ods("o_order", [dt]).collect())


def test_snapshots_of_all_days_stay(spark):
    house = daily.Warehouse(spark, scratch_path(spark, "days"))
    daily.import_day(house, orders(spark, (1, "5.00", 10)), D1)
    daily.import_day(house, orders(spark, (1, "5.00", 10), (2, "7.00", 11)), D2)
    assert amounts(house, D1) == [(1, "5.00")] and len(amounts(house, D2)) == 2
    daily.clean_day(house, D1, "now")
    assert house.dwd("o_order", [D1]).count() == 1
    (row,) = daily.check_partitions(house, ["o_order"], D1).collect()
    assert row["present"] and row["data_files"] > 0
    daily.import_day(house, orders(spark, (3, "1.00", 9)), D1)
    assert amounts(house, D1) == [(3, "1.00")] and len(amounts(house, D2)) == 2


def test_windows_and_snapshots_do_not_add_up(spark):
    house = daily.Warehouse(spark, scratch_path(spark, "windows"))
    daily.import_changes(house, orders(spark, (1, "5.00", 10)), D1, f"{D1} 11:00:00")
    daily.import_day(house, orders(spark, (1, "5.00", 10), (2, "6.00", 10), (None, "3.00", 10)), D1)
    assert house.ods("o_order", [D1]).count() == 3
    daily.import_changes(house, orders(spark, (1, "8.00", 11), (None, "4.00", 11)), D1, f"{D1} 12:00:00")
    daily.import_changes(house, orders(spark, (1, "9.00", 12)), D1, f"{D1} 13:00:00")
    got = {r["order_id"]: str(r["total_amount"]) for r in house.ods("o_order", [D1]).filter("order_id is not null").collect()}
    assert got == {1: "9.00", 2: "6.00"}
    assert house.ods("o_order", [D1]).count() == 4  # rows without a key stay
    assert house.ods("o_order", [D1]).agg(F.sum("total_amount")).head()[0] == Decimal("22.00")
    assert ORDER.key == "order_id"


def test_catalog_partitions_are_published_loads(spark):
    spark.sql("create database if not exists gated")
    house = daily.Warehouse(spark, scratch_path(spark, "gated"), "gated")
    daily.import_day(house, orders(spark, (1, "5.00", 10)), D1)
    daily.import_day(house, orders(spark, (1, "5.00", 10), (2, "6.00", 10)), D2)
    daily.import_day(house, orders(spark, (4, "1.00", 10)), D1)
    loads.write_load(orders(spark, (9, "9.00", 10))["o_order"], house.ods_path("o_order"), D2, "since_1")
    listed = {r[0] for r in spark.sql("show partitions gated.ods_o_order").collect()}
    assert listed == {x.folder for x in loads.published(spark, house.ods_path("o_order"))}
    assert {r["order_id"] for r in spark.table("gated.ods_o_order").collect()} == {1, 2, 4}
    spark.sql("drop table gated.ods_o_order")


def test_only_windows_are_ranked(spark, tmp_path):
    """A snapshot of a day loses the keys that windows have; it is not sorted by key, and no row's load name is parsed."""
    house = daily.Warehouse(spark, str(tmp_path))
    path = house.ods_path("o_order")
    schema = "order_id int, total_amount decimal(10,2)"

    def put(name, *rows):
        made = [(i, Decimal(a)) for i, a in rows]
        load = loads.write_load(spark.createDataFrame(made, schema), path, D1, name)
        loads.publish(spark, path, [load], everywhere=False)

    put("full", (1, "1"), (1, "2"), (2, "3"), (3, "4"), (None, "5"))
    put("since_1", (2, "10"), (2, "11"), (3, "12"), (None, "13"))
    rows = lambda: sorted((str(r["order_id"]), int(r["total_amount"])) for r in house.ods("o_order", [D1]).collect())
    assert rows() == [("1", 1), ("1", 2), ("2", 10), ("2", 11), ("3", 12), ("None", 5), ("None", 13)]
    text = house.ods("o_order", [D1])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in text and "regexp" not in text
    put("since_2", (3, "20"), (3, "21"), (4, "22"), (None, "23"))
    assert rows() == [("1", 1), ("1", 2), ("2", 10), ("2", 11), ("3", 20), ("3", 21), ("4", 22), ("None", 5), ("None", 13), ("None", 23)]
