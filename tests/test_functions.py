from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal
import random

import pytest
from pyspark.sql import functions as F

from layerloom.functions import numbers, rules, times
from layerloom.params import check_dt, check_policy, run_dt
from layerloom.session import cluster_settings, scratch_path


def test_normalise_time(spark, rows):
    cases = {
        "2024-01-05 08:09:10": "2024-01-05 08:09:10",
        "2024-01-05 08:09:10.0": "2024-01-05 08:09:10",
        "2024-01-05 08:09:10.123456": "2024-01-05 08:09:10",
        "2024-01-05 00:00:00": "2024-01-05 00:00:00",
        "2024-01-05": None,
        "2024-13-05 08:09:10": None,
        "2024-02-30 08:09:10": None,
        "2024-01-05 08:09:10abc": None,
        "2024-01-05T08:09:10": None,
        "bad": None,
        "": None,
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string")
    got = {r.t: r.n for r in df.select("t", times.normalise_time("t").alias("n")).collect()}
    assert got == {**cases, None: None}


def test_time_parts(spark):
    df = spark.createDataFrame([("2024-01-05 18:59:59",), ("bad",)], "t string")
    got = df.select(times.business_day("t"), times.hour_of("t"), times.day_of("t")).collect()
    assert [tuple(r) for r in got] == [("2024-01-05", 18, date(2024, 1, 5)), (None, None, None)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_epoch_ms_does_not_follow_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1704067205123,), (-1,), (2**62,), (None,)], "ms bigint")
        got = df.select(times.epoch_ms_text("ms"), times.epoch_ms_day("ms")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [tuple(r) for r in got] == [
        ("2024-01-01 00:00:05", "2024-01-01"),
        ("1969-12-31 23:59:59", "1969-12-31"),
        (None, None),
        (None, None),
    ]


def test_epoch_round_trip(spark):
    df = spark.createDataFrame([(1704067205123,)], "ms bigint")
    assert df.select(times.to_epoch_ms(times.epoch_ms_time("ms"))).first()[0] == 1704067205123


def test_on_day_is_half_open(spark):
    stamps = [datetime(2024, 1, 4, 23, 59, 59), datetime(2024, 1, 5), datetime(2024, 1, 5, 23, 59), datetime(2024, 1, 6)]
    df = spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz")
    kept = [r.t for r in df.filter(times.on_day("t", "2024-01-05")).orderBy("t").collect()]
    assert kept == stamps[1:3]


def test_ratio_rounds_half_up_exactly(spark):
    rng = random.Random(7)
    pairs = [(rng.randint(0, 10**rng.randint(1, 15)), rng.randint(1, 10**rng.randint(1, 9))) for _ in range(500)]
    pairs += [(1, 8), (1, 3), (2, 3), (5, 1000), (15, 1000), (-1, 3), (-5, 1000), (0, 5), (7, 0)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    money = numbers.half_up_ratio(F.col("n"), F.col("d"), 2, "decimal(20,2)", num_scale=2)
    for r in df.select("n", "d", money.alias("q")).collect():
        want = Decimal(0)
        if r.d:
            want = (Decimal(r.n) / 100 / r.d).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert r.q == want, r


def test_rate_and_average(spark):
    df = spark.createDataFrame([(1, 3, 100, 8), (0, 0, 0, 0), (2, 3, 1005, 2)], "n bigint, d bigint, c bigint, k bigint")
    got = df.select(
        numbers.half_up_ratio(F.col("n"), F.col("d"), 4, "decimal(5,4)"),
        numbers.average_price(F.col("c"), F.col("k")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (Decimal("0.3333"), Decimal("0.13")),
        (Decimal("0.0000"), None),
        (Decimal("0.6667"), Decimal("5.03")),
    ]


def test_average_is_rounded_at_six_digits_first(spark):
    # 0.0049999996 has six digits 0.005000, which the sink rounds up.
    n = 10**9
    df = spark.createDataFrame([(499_999_960, n)], "c bigint, k bigint")
    assert df.select(numbers.average_price(F.col("c"), F.col("k"))).first()[0] == Decimal("0.01")


def test_cents(spark):
    df = spark.createDataFrame([(Decimal("99999999.99"),), (Decimal("-0.01"),), (None,)], "a decimal(10,2)")
    got = df.select(numbers.cents("a").alias("c")).collect()
    assert [r.c for r in got] == [9_999_999_999, -1, None]
    assert df.select(numbers.from_cents(numbers.cents("a"))).first()[0] == Decimal("99999999.99")


def test_value_rules(spark):
    df = spark.createDataFrame(
        [(Decimal("-0.01"), 0), (Decimal("0.00"), 1), (None, None), (Decimal("5.50"), 3), (Decimal("1.00"), 4)],
        "a decimal(10,2), s tinyint",
    )
    got = df.select(
        rules.non_negative("a"), rules.non_negative("a", null_to_zero=True), rules.checked_status("s")
    ).collect()
    zero = Decimal("0.00")
    assert [tuple(r) for r in got] == [
        (zero, zero, -1),
        (zero, zero, 1),
        (None, zero, -1),
        (Decimal("5.50"), Decimal("5.50"), 3),
        (Decimal("1.00"), Decimal("1.00"), -1),
    ]


def test_run_parameters():
    assert run_dt(today=date(2024, 3, 1)) == "2024-02-29"
    assert run_dt("2024-01-31") == "2024-01-31"
    for bad in ("2024-1-1", "2024-02-30", "20240101", "", None):
        with pytest.raises(ValueError):
            check_dt(bad)
    with pytest.raises(ValueError):
        check_policy("today")


def test_cluster_settings():
    big = cluster_settings(10 * 1024**4, cores=4000)
    assert big["spark.sql.shuffle.partitions"] == "81920"
    assert cluster_settings(1, cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{shared}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
