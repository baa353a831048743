from decimal import Decimal
import random

import pytest

from layerloom.operators.clean import clean_order_details, clean_orders, clean_products, clean_users
from layerloom.operators.merge import latest_rows, merge_table

ETL = "2024-01-02 03:04:05"


def test_clean_users(spark, rows):
    ods = spark.createDataFrame(
        [
            (1, "  a b  ", "2024-01-01 10:00:00.0", "d1"),
            (2, "\ttab ", "bad", "d1"),
            (None, "lost", "2024-01-01 10:00:00", "d1"),
            (1, "again", None, "d2"),
        ],
        "user_id int, username string, register_time string, dt string",
    )
    got = clean_users(ods, ETL)
    assert got.columns == ["user_id", "username", "register_time", "data_source", "etl_time", "dt"]
    assert rows(got) == [
        (1, "a b", "2024-01-01 10:00:00", "mysql_demo_oltp", ETL, "d1"),
        (1, "again", None, "mysql_demo_oltp", ETL, "d2"),
        (2, "\ttab", None, "mysql_demo_oltp", ETL, "d1"),
    ]
    assert clean_users(ods, ETL, dt="d2").count() == 1


def test_clean_products_keeps_a_null_price(spark, rows):
    ods = spark.createDataFrame(
        [(1, " x ", Decimal("-1.00"), "2024-01-01 00:00:00", "d"), (2, "y", None, None, "d"), (None, "z", None, None, "d")],
        "product_id int, product_name string, price decimal(10,2), create_time string, dt string",
    )
    assert rows(clean_products(ods), "product_id", "product_name", "price") == [
        (1, "x", Decimal("0.00")),
        (2, "y", None),
    ]


def test_clean_orders(spark, rows):
    ods = spark.createDataFrame(
        [
            (1, 7, Decimal("-0.01"), 0, "2024-01-01 00:00:00", "d"),
            (2, 7, None, None, "2024-01-01 00:00:00", "d"),
            (3, None, Decimal("9.99"), 3, "bad", "d"),
            (None, 7, Decimal("9.99"), 3, "bad", "d"),
        ],
        "order_id int, user_id int, total_amount decimal(10,2), order_status tinyint, create_time string, dt string",
    )
    got = clean_orders(ods, ETL)
    assert dict(got.dtypes)["order_status"] == "tinyint"
    assert rows(got, "order_id", "total_amount", "order_status", "create_time") == [
        (1, Decimal("0.00"), -1, "2024-01-01 00:00:00"),
        (2, Decimal("0.00"), -1, "2024-01-01 00:00:00"),
        (3, Decimal("9.99"), 3, None),
    ]


def test_clean_order_details_only_maps(spark, rows):
    ods = spark.createDataFrame(
        [(1, 2, 3, 4, "t", "u", "d"), (None, 2, 3, 4, "t", "u", "d")],
        "detail_id int, order_id int, product_id int, quantity int, create_time string, update_time string, dt string",
    )
    assert rows(clean_order_details(ods, ETL)) == [(1, 2, 3, 4, "t", "mysql_demo_oltp", ETL, "d")]


LOG = "user_id int, username string, register_time string, op_type string, op_ts string, seq int, dt string"


def log(spark, changes):
    """Changes as (user_id, name, op_type, op_ts, seq, dt)."""
    return spark.createDataFrame([(u, n, "r", o, t, s, d) for u, n, o, t, s, d in changes], LOG)


CHANGES = [
    (1, "v1", "INSERT", "10:00", 1, "d1"),
    (1, "v2", "UPDATE", "10:05", 2, "d1"),
    (1, "v3", "DELETE", "10:06", 3, "d1"),
    (2, "back1", "DELETE", "10:00", 1, "d1"),
    (2, "back2", "INSERT", "10:01", 2, "d1"),
    (3, "full", None, None, 0, "d1"),
    (4, "tie a", "UPDATE", "10:00", 5, "d1"),
    (4, "tie b", "UPDATE", "10:00", 6, "d1"),
    (5, "old day", "INSERT", "09:00", 1, "d1"),
    (5, "new day", "UPDATE", "11:00", 9, "d2"),
    (6, "no time", "UPDATE", None, 3, "d1"),
    (6, "timed", "UPDATE", "08:00", 1, "d1"),
    (None, "no key", "INSERT", "10:00", 1, "d1"),
]


@pytest.mark.parametrize(
    "options, want",
    [
        ({}, {(1, "v2"), (2, "back2"), (4, "tie b"), (5, "old day"), (5, "new day"), (6, "timed"), (None, "no key")}),
        ({"dt": "d2"}, {(5, "new day")}),
        ({"scope": "all"}, {(1, "v2"), (2, "back2"), (4, "tie b"), (5, "new day"), (6, "timed"), (None, "no key")}),
        (
            {"scope": "all", "delete_mode": "tombstone"},
            {(2, "back2"), (4, "tie b"), (5, "new day"), (6, "timed"), (None, "no key")},
        ),
        (
            {"scope": "all", "null_op": "keep"},
            {(1, "v2"), (2, "back2"), (3, "full"), (4, "tie b"), (5, "new day"), (6, "timed"), (None, "no key")},
        ),
    ],
)
def test_merge_modes(spark, options, want):
    got = merge_table(log(spark, CHANGES), "u_user", **options)
    assert {(r.user_id, r.username) for r in got.collect()} == want
    assert got.columns == ["user_id", "username", "register_time", "data_source", "etl_time", "dt"]


def test_merge_does_not_trim(spark):
    got = merge_table(log(spark, [(1, "  a ", "INSERT", "1", 1, "d")]), "u_user").first()
    assert got.username == "  a "


def test_merge_rejects_unknown_modes(spark):
    for bad in ({"scope": "x"}, {"delete_mode": "x"}, {"null_op": "x"}):
        with pytest.raises(ValueError):
            merge_table(log(spark, CHANGES), "u_user", **bad)


def test_order_merge_keeps_null_amounts(spark, rows):
    ods = spark.createDataFrame(
        [(1, 7, None, 9, "t", "INSERT", "1", "d"), (2, 7, Decimal("-5.00"), 2, "t", "UPDATE", "1", "d")],
        "order_id int, user_id int, total_amount decimal(10,2), order_status tinyint, create_time string, "
        "op_type string, op_ts string, dt string",
    )
    got = rows(merge_table(ods, "o_order"), "order_id", "total_amount", "order_status")
    assert got == [(1, None, -1), (2, Decimal("0.00"), 2)]


def test_merge_equals_ranking_on_random_logs(spark):
    rng = random.Random(3)
    changes = [
        (rng.choice([None, *range(8)]), f"n{i}", rng.choice(["INSERT", "UPDATE", "DELETE", None]),
         rng.choice([None, "1", "2", "3"]), rng.randint(0, 3), rng.choice(["d1", "d2"]))
        for i in range(400)
    ]
    df = log(spark, changes)
    for scope in ("dt", "all"):
        for mode in ("filter", "tombstone"):
            got = merge_table(df, "u_user", scope=scope, delete_mode=mode)
            best = {}
            for u, n, o, t, s, d in changes:
                if o is None or (mode == "filter" and o == "DELETE"):
                    continue
                key = (u, d) if scope == "dt" else u
                rank = (t is not None, t or "", s, n)
                if key not in best or rank > best[key][0]:
                    best[key] = (rank, (u, n, d), o)
            want = {row for _, row, o in best.values() if o != "DELETE"}
            assert {(r.user_id, r.username, r.dt) for r in got.collect()} == want


def test_latest_rows_is_repeatable(spark, rows):
    df = log(spark, [(1, f"n{i}", "UPDATE", "1", 1, "d") for i in range(50)])
    first = rows(latest_rows(df, ["user_id"], ["op_ts", "seq"]))
    assert first == rows(latest_rows(df.repartition(7), ["user_id"], ["op_ts", "seq"]))
    assert len(first) == 1
