from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerloom.plans import daily, runlog, trends
from layerloom.schemas import SOURCE_TABLES
from layerloom.session import scratch_path
from layerloom.sources import marks, synthetic

DT, ETL = "2024-01-31", "2024-02-01 01:00:00"


@pytest.fixture(scope="module")
def sources(spark):
    made = synthetic.updated_tables(spark, DT, users=40, products=15, orders=60, details=120)
    return {name: df.persist() for name, df in made.items()}


@pytest.fixture(scope="module")
def house(spark, sources):
    root = scratch_path(spark, "house")
    assert daily.run_day(spark, root, sources, DT, ETL) == dict.fromkeys(runlog.STEPS, 1)
    return daily.Warehouse(spark, root)


def test_all_layers_are_written(house):
    assert {t: house.ods(t).count() for t in SOURCE_TABLES} == {
        "u_user": 40, "p_product": 15, "o_order": 60, "o_order_detail": 120,
    }
    assert {t: house.dwd(t).count() for t in ("u_user", "p_product", "o_order")} == {"u_user": 40, "p_product": 15, "o_order": 60}
    row = house.dws("dws_order_stats_di").first()
    assert (row.total_order_count, row.dt, row.etl_time) == (60, DT, ETL)
    assert row.total_order_amount == house.ods("o_order").agg(F.sum("total_amount")).first()[0]
    assert house.dws("dws_user_stats_di").first().total_user_count == 40
    assert house.dws("dws_product_stats_di").first().total_product_count == 15
    assert house.dws("dws_user_order_basic_di").first().order_user_rate <= 1


def test_run_is_repeatable(spark, house, sources, rows):
    before = {t: rows(house.dws(t)) for t in daily.day_metrics(house, [DT], ETL)}
    metrics_before = rows(house.run_metrics.read().filter(~F.col("metric").contains("cost")))
    daily.run_day(spark, house.root, sources, DT, ETL)
    assert {t: rows(house.dws(t)) for t in before} == before
    assert rows(house.run_metrics.read().filter(~F.col("metric").contains("cost"))) == metrics_before


def test_run_metrics_are_stored(house, rows):
    stored = house.run_metrics.read()
    assert rows(runlog.lookup(stored, names=[runlog.SYNC_ROWS]), "business", "value", "date") == [
        ("sqoop_ods_full_sync_o_order", 60, DT),
        ("sqoop_ods_full_sync_o_order_detail", 120, DT),
        ("sqoop_ods_full_sync_p_product", 15, DT),
        ("sqoop_ods_full_sync_u_user", 40, DT),
    ]
    assert runlog.lookup(stored, names=[runlog.SYNC_TOTAL_ROWS]).first().value == 235
    statuses = runlog.lookup(stored, names=[runlog.STEP_STATUS], pattern="full_data_governance_flow.*")
    assert [r.value for r in statuses.collect()] == [1] * 5
    assert stored.count() == 4 + 2 + 5 + 3


def test_a_missing_source_partition_stops_the_run(spark, sources, house, monkeypatch):
    root = scratch_path(spark, "house")
    monkeypatch.setattr(daily, "import_day", lambda *_: {})
    with pytest.raises(Exception):
        daily.run_day(spark, root, sources, DT, ETL)
    stored = daily.Warehouse(spark, root).run_metrics.read()
    status = {r.business.removeprefix("full_data_governance_flow_"): r.value for r in runlog.lookup(stored, names=[runlog.STEP_STATUS]).collect()}
    assert status == {"ods_sync": 1, "row_check": 1, "partition_check": 0, "dwd_clean": 0, "dws_agg": 0}
    assert runlog.lookup(stored, names=[runlog.FLOW_SUCCESS]).first().value == 0


def test_counts_come_from_the_writers(spark, sources, monkeypatch):
    """No raw file is read for them, and they equal the rows that readers see, also of an empty table."""
    counted, real = [], daily.row_counts
    monkeypatch.setattr(daily, "row_counts", lambda frames: counted.extend(f for df in frames.values() for f in df.inputFiles()) or real(frames))
    some = dict(sources, o_order_detail=sources["o_order_detail"].limit(0))
    root = scratch_path(spark, "house")
    daily.run_day(spark, root, some, DT, ETL)
    assert not [f for f in counted if "/ods/" in f]
    house = daily.Warehouse(spark, root)
    assert daily.import_day(house, some, DT) == {t: house.ods(t, [DT]).count() for t in some}
    stored = {r["business"]: r["value"] for r in house.run_metrics.read().filter(F.col("metric") == runlog.SYNC_ROWS).collect()}
    assert stored == {f"{runlog.SYNC_LABEL}_{t}": house.ods(t, [DT]).count() for t in some}


def test_strict_counts(spark, sources, monkeypatch):
    more = dict(sources, u_user=sources["u_user"])
    real = daily.import_day
    fewer = dict(sources, u_user=sources["u_user"].limit(30))
    monkeypatch.setattr(daily, "import_day", lambda house, _, dt: real(house, fewer, dt))
    with pytest.raises(daily.CheckFailed):
        daily.run_day(spark, scratch_path(spark, "house"), more, DT, ETL, strict_counts=True)


def test_checks_of_a_day(spark, house, sources, rows):
    assert [r.passed for r in daily.check_counts(house, sources, DT).collect()] == [True] * 4
    counts = spark.createDataFrame([(n, 1 if n == "u_user" else df.count()) for n, df in sources.items()], "table_name string, row_count bigint")
    given = {r.table_name: r.passed for r in daily.check_counts(house, sources, DT, counts).collect()}
    assert given == {"u_user": False, "p_product": True, "o_order": True, "o_order_detail": True}
    found = daily.check_partitions(house, sources, DT).collect()
    assert all(r.present and r.data_files > 0 for r in found) and len(found) == 4
    other = daily.check_partitions(house, sources, "2024-02-02").collect()
    assert not any(r.present or r.data_files for r in other)


def test_an_empty_source_is_no_missing_partition(spark, sources):
    root = scratch_path(spark, "house")
    status = daily.run_day(spark, root, dict(sources, o_order_detail=sources["o_order_detail"].limit(0)), DT, ETL)
    assert all(status.values())


def test_backfill_equals_daily_runs(house, rows):
    everything = daily.day_metrics(house, None, ETL)
    for table, df in everything.items():
        assert rows(df.filter(F.col("dt") == DT)) == rows(daily.day_metrics(house, [DT], ETL)[table])


def test_digests_equal_the_whole_history(spark, rows):
    root = scratch_path(spark, "house")
    house = daily.Warehouse(spark, root)
    days = ["2024-01-10", "2024-01-12", "2024-01-20"]
    tables = ("dws_user_stats_di", "dws_product_stats_di")

    def write(day, seed):
        made = synthetic.updated_tables(spark, day, seed=seed, users=30, products=20, orders=30, details=30, history_days=3)
        for name in ("u_user", "p_product", "o_order"):
            daily.overwrite_partition(daily.import_full(made[name], SOURCE_TABLES[name], day), house.ods_path(name), day)
        daily.clean_day(house, day, ETL)

    def check(day):
        daily.aggregate_day(house, day, ETL, use_digests=True)
        want = daily.day_metrics(house, [day], ETL)
        for table in tables:
            names = house.dws(table).columns
            stored = house.dws(table).filter(F.col("dt") == day)
            assert rows(stored) == rows(want[table].select(*names))

    for n, day in enumerate(days):
        write(day, n)
        check(day)
    assert daily.partition_days(spark, house.digest_path("u_user")) == days
    write(days[1], 9)
    check(days[1])
    assert daily.partition_days(spark, house.digest_path("u_user")) == days[:2]
    check(days[2])


def test_incremental_import(spark, sources):
    house = daily.Warehouse(spark, scratch_path(spark, "house"))
    users = {"u_user": sources["u_user"]}
    daily.import_changes(house, users, DT, now="2023-10-01 00:00:00")
    first = house.ods("u_user").count()
    daily.import_changes(house, users, DT, now="2024-02-01 00:00:00")
    daily.import_changes(house, users, DT, now="2024-02-02 00:00:00")
    assert 0 < first < 40 and house.ods("u_user").count() == 40
    assert house.marks.current("u_user") == "2024-02-02 00:00:00"


def test_a_failed_import_keeps_its_mark(spark, sources):
    house = daily.Warehouse(spark, scratch_path(spark, "house"))
    broken = sources["o_order"].withColumn("total_amount", F.raise_error(F.lit("lost")).cast("decimal(10,2)"))
    with pytest.raises(Exception, match="lost"):
        daily.import_changes(house, {"u_user": sources["u_user"], "o_order": broken}, DT, now="2024-02-01 00:00:00")
    assert house.marks.current("o_order") == marks.FIRST_MARK
    assert house.marks.current("u_user") == "2024-02-01 00:00:00"
    assert house.ods("o_order").count() == 0


def metric(spark, *rows):
    return spark.createDataFrame(list(rows), runlog.SCHEMA)


def test_metric_store(spark, rows):
    store = runlog.MetricStore(spark, scratch_path(spark, "metrics"))
    assert store.read().count() == 0
    store.report([metric(spark, ("m", "a", 1, DT), ("m", "b", 2, DT))], DT)
    store.report([metric(spark, ("m", "a", 5, DT)), metric(spark, ("n", "a", 7, DT))], DT)
    store.report([metric(spark, ("m", "a", 9, "2024-02-01"))], "2024-02-01")
    assert rows(store.read()) == [
        ("m", "a", 5, DT), ("m", "a", 9, "2024-02-01"), ("m", "b", 2, DT), ("n", "a", 7, DT),
    ]
    store.purge(DT)
    assert rows(store.read()) == [("m", "a", 9, "2024-02-01")]


def test_metric_lines_and_lookup(spark, rows):
    df = metric(spark, ("m", "x_a", 1, DT), ("m", "x_a", 1, DT), ("m", "x_a", 2, DT), ("n", "xx", 1, "2024-02-01"))
    assert rows(runlog.text_lines(runlog.distinct_lines(df))) == [
        (f'm{{business="x_a",date="{DT}"}} 1',),
        (f'm{{business="x_a",date="{DT}"}} 2',),
        ('n{business="xx",date="2024-02-01"} 1',),
    ]
    assert runlog.lookup(df, date=DT).count() == 3
    assert runlog.lookup(df, business="xx").count() == 1
    assert runlog.lookup(df, pattern="x_.*").count() == 3
    assert runlog.lookup(df, pattern="x").count() == 0
    assert runlog.lookup(df, pattern="x_b|xx").count() == 1


def test_trends(house):
    frames = {t: house.dws(t) for t in daily.day_metrics(house, [DT], ETL)}
    series = trends.trend_series(frames, DT)
    assert {t: df.count() for t, df in series.items()} == dict.fromkeys(frames, 1)
    assert series["dws_order_stats_di"].columns == ["dt", "total_order_count", "total_order_amount"]
    assert isinstance(series["dws_order_stats_di"].first().total_order_amount, Decimal)
