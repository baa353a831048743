from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerloom.operators import quality, rollup
from layerloom.schemas import SOURCE_TABLES

DETAILS = "detail_id int, order_id int, product_id int, quantity int, create_time string"


def ids(spark, n):
    return spark.range(n)


@pytest.mark.parametrize(
    "src, tgt, diff, passed",
    [
        (0, 0, 0.0, True),
        (0, 1, 100.0, False),
        (1000, 1001, 0.1, False),
        (10000, 9991, 0.09, True),
        (5, 5, 0.0, True),
        (4, 0, 100.0, False),
    ],
)
def test_row_count_check(spark, src, tgt, diff, passed):
    (row,) = quality.row_count_check([quality.CountPair("t", ids(spark, src), ids(spark, tgt))]).collect()
    assert (row.table_name, row.src, row.tgt, row.passed) == ("t", src, tgt, passed)
    assert row.diff_pct == pytest.approx(diff)


def test_row_counts_and_total(spark, rows):
    counts = quality.row_counts({"a": ids(spark, 3), "b": ids(spark, 0)})
    assert rows(counts) == [("a", 3), ("b", 0)]
    assert quality.total_rows(counts).first().total_rows == 3


def test_created_on(spark):
    text = spark.createDataFrame([("2024-01-05 23:59:59",), ("2024-01-06 00:00:00",), ("bad",), (None,)], "t string")
    assert quality.created_on(text, "t", "2024-01-05").count() == 1
    stamp = text.select(F.col("t").try_cast("timestamp_ntz").alias("t"))
    assert quality.created_on(stamp, "t", "2024-01-05").count() == 1


def test_partition_presence(spark, rows):
    a = spark.createDataFrame([("2024-01-01",), ("2024-01-01",)], "dt string")
    b = spark.createDataFrame([("2024-01-02",)], "dt string")
    got = quality.partition_presence({"a": a, "b": b}, ["2024-01-01", "2024-01-02"])
    assert rows(got, "table_name", "dt", "present") == [
        ("a", "2024-01-01", True),
        ("a", "2024-01-02", False),
        ("b", "2024-01-01", False),
        ("b", "2024-01-02", True),
    ]


def test_census_duplicates_domains_nulls(spark, rows):
    df = spark.createDataFrame(
        [(1, "INSERT", Decimal("-1.00"), 9, "d"), (1, None, None, None, "d"), (2, None, Decimal("0.00"), -1, "d"), (1, None, None, 1, "e")],
        "k int, op_type string, price decimal(10,2), order_status tinyint, dt string",
    )
    assert rows(quality.op_type_census(df)) == [("d", "INSERT", 1), ("d", None, 2), ("e", None, 1)]
    assert rows(quality.duplicate_keys(df, "k")) == [("d", 1, 2)]
    assert rows(quality.duplicate_keys(df, "k", by=())) == [(1, 3)]
    rules = {"price": quality.price_below_zero(), "status": quality.status_out_of_domain()}
    assert rows(quality.violation_counts(df, rules)) == [("price", 1), ("status", 1)]
    assert quality.violations(df, rules["status"]).first().order_status == 9
    assert rows(quality.null_counts(df, ["k", "op_type", "price"])) == [("k", 0), ("op_type", 3), ("price", 2)]


def test_orphans(spark, rows):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k int")
    parent = spark.createDataFrame([(2,), (2,), (None,), (7,)], "pk int")
    assert rows(quality.foreign_key_orphans(child, "k", parent, "pk")) == [(1, 2), (3, 1)]


def test_declared_orphans(spark, rows):
    frames = {
        "u_user": spark.createDataFrame([(1,)], "user_id int"),
        "p_product": spark.createDataFrame([(5,)], "product_id int"),
        "o_order": spark.createDataFrame([(10, 1), (11, 2)], "order_id int, user_id int"),
        "o_order_detail": spark.createDataFrame([(1, 10, 5), (2, 12, 5), (3, 10, 6)], "detail_id int, order_id int, product_id int"),
    }
    assert rows(quality.declared_orphans(frames, SOURCE_TABLES)) == [
        ("o_order", "user_id", 2, 1),
        ("o_order_detail", "order_id", 12, 1),
        ("o_order_detail", "product_id", 6, 1),
    ]


@pytest.fixture
def shop(spark):
    products = spark.createDataFrame([(1, Decimal("2.50")), (2, Decimal("9.99")), (3, None)], "product_id int, price decimal(10,2)")
    details = spark.createDataFrame(
        [(1, 10, 1, 2, "x"), (2, 10, 2, 3, "x"), (3, 11, 3, 1, "x"), (4, 12, 9, 1, "x"), (5, None, 1, 4, "x")], DETAILS
    )
    orders = spark.createDataFrame(
        [(10, Decimal("34.97"), "t10"), (11, Decimal("1.00"), "t11"), (13, Decimal("5.00"), "t13")],
        "order_id int, total_amount decimal(10,2), create_time string",
    )
    return orders, details, products


def test_order_amounts(shop, rows):
    _, details, products = shop
    assert rows(rollup.order_amounts(details, products)) == [
        (10, 2, Decimal("34.97")),
        (11, 1, None),
        (None, 1, Decimal("10.00")),
    ]


def test_amount_differences(shop, rows):
    orders, details, products = shop
    assert rows(rollup.amount_differences(orders, details, products)) == [
        (10, Decimal("34.97"), Decimal("34.97"), Decimal("0.00")),
        (11, Decimal("1.00"), None, Decimal("1.00")),
        (13, Decimal("5.00"), None, Decimal("5.00")),
        (None, None, Decimal("10.00"), Decimal("-10.00")),
    ]


def test_details_at_order_time(shop, rows):
    orders, details, _ = shop
    got = rollup.details_at_order_time(details, orders)
    assert rows(got, "detail_id", "create_time") == [(1, "t10"), (2, "t10"), (3, "t11")]


def test_snapshots_of_a_product_count_once(spark, rows):
    details = spark.createDataFrame([(1, 7, 1, 2)], "detail_id int, order_id int, product_id int, quantity int")
    days = [(1, "2024-01-01", "5.00"), (1, "2024-01-02", "3.00"), (1, "bad", "9.00"), (2, "2024-01-01", None)]
    products = spark.createDataFrame(days, "product_id int, dt string, price string").withColumn("price", F.col("price").cast("decimal(10,2)"))
    assert [(r.order_id, r.detail_count, str(r.order_amount)) for r in rollup.order_amounts(details, products).collect()] == [(7, 1, "6.00")]
    prices = {r.product_id: r.price for r in rollup.latest_prices(products).collect()}
    assert str(prices[1]) == "3.00" and prices[2] is None
