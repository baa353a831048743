"""Metrics against a direct evaluation of their definitions on random dirty rows."""

from decimal import ROUND_HALF_UP, Decimal
import random

import pytest

from layerloom.operators import history, metrics

DAYS = [f"2024-01-{d:02d}" for d in range(1, 7)]
ORDERS = "order_id int, user_id int, total_amount decimal(10,2), order_status tinyint, create_time string, dt string"
USERS = "user_id int, username string, register_time string, dt string"
PRODUCTS = "product_id int, product_name string, price decimal(10,2), create_time string, dt string"


def half_up(num, den, digits):
    if den == 0:
        return Decimal(0).quantize(Decimal(1).scaleb(-digits))
    return (Decimal(num) / den).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


def some_time(rng, day=None):
    if rng.random() < 0.1:
        return rng.choice([None, "bad"])
    return f"{day or rng.choice(DAYS)} {rng.choice([0, 8, 9, 17, 18, 19, 23]):02d}:{rng.choice([0, 59]):02d}:59"


def hour(text):
    return int(text[11:13]) if text and text != "bad" else None


def day(text):
    return text[:10] if text and text != "bad" else None


def count(items):
    return len({i for i in items if i is not None})


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    orders = [
        (rng.choice([None, *range(40)]), rng.choice([None, *range(9)]),
         rng.choice([None, Decimal(rng.randint(0, 99999)).scaleb(-2)]), rng.choice([None, -1, 1, 2, 3]),
         some_time(rng), rng.choice(DAYS[:-1]))
        for _ in range(300)
    ]
    users = [
        (rng.choice([None, *range(30)]), "n", some_time(rng), rng.choice(DAYS[1:])) for _ in range(200)
    ]
    products = [
        (rng.choice([None, *range(25)]), "n",
         rng.choice([None, Decimal(rng.randint(9990, 10010)).scaleb(-2)]), some_time(rng), rng.choice(DAYS))
        for _ in range(200)
    ]
    return orders, users, products


def by_dt(df):
    return {r.dt: {k: v for k, v in r.asDict().items() if k not in ("dt", "etl_time")} for r in df.collect()}


def order_day(orders, d):
    rows = [o for o in orders if o[5] == d]
    n, users = count(o[0] for o in rows), count(o[1] for o in rows)
    amount = sum((o[2] for o in rows if o[2] is not None), Decimal("0.00"))
    valid = count(o[0] for o in rows if o[3] == 1)
    night = count(o[0] for o in rows if (hour(o[4]) or 0) >= 18)
    return {
        "total_order_count": n,
        "total_order_amount": amount,
        "avg_order_amount": half_up(amount, n, 2),
        "valid_order_count": valid,
        "valid_order_rate": half_up(valid, n, 4),
        "night_order_rate": half_up(night, n, 4),
        "per_user_amount": half_up(amount, users, 2),
    }


def test_order_stats(spark, data):
    df = spark.createDataFrame(data[0], ORDERS)
    assert by_dt(metrics.order_daily_stats(df)) == {d: order_day(data[0], d) for d in DAYS[:-1]}
    asked = [DAYS[2], DAYS[-1], "2031-05-05"]
    assert by_dt(metrics.order_daily_stats(df, asked)) == {d: order_day(data[0], d) for d in asked}


def test_a_day_without_amounts_has_no_average(spark):
    df = spark.createDataFrame([(1, 7, None, 1, "2024-01-01 10:00:00", "2024-01-01")], ORDERS)
    row = by_dt(metrics.order_daily_stats(df))["2024-01-01"]
    assert (row["total_order_amount"], row["avg_order_amount"], row["per_user_amount"]) == (0, None, None)
    assert (row["total_order_count"], row["valid_order_rate"]) == (1, 1)


def test_order_stats_of_another_state(spark, data):
    df = spark.createDataFrame(data[0], ORDERS)
    got = by_dt(metrics.order_daily_stats(df, valid_status=2))
    for d in DAYS[:-1]:
        assert got[d]["valid_order_count"] == count(o[0] for o in data[0] if o[5] == d and o[3] == 2)


def user_day(users, d):
    rows = [u for u in users if u[3] <= d]
    new = {u[0] for u in rows if day(u[2]) == d and u[0] is not None}
    work = {u[0] for u in rows if day(u[2]) == d and u[0] is not None and 9 <= hour(u[2]) <= 18}
    return {
        "new_user_count": len(new),
        "total_user_count": count(u[0] for u in rows),
        "workhour_register_rate": half_up(len(work), len(new), 4),
    }


def test_user_stats(spark, data):
    df = spark.createDataFrame(data[1], USERS)
    assert by_dt(metrics.user_daily_stats(df)) == {d: user_day(data[1], d) for d in DAYS[1:]}
    asked = [DAYS[0], DAYS[3], "2024-01-31"]
    assert by_dt(metrics.user_daily_stats(df, asked)) == {d: user_day(data[1], d) for d in asked}


def product_day(products, d):
    rows = [p for p in products if p[4] <= d]
    total = count(p[0] for p in rows)
    prices = [p[2] for p in rows if p[2] is not None]
    average = Decimal("0.00")
    if total and prices:
        average = half_up(half_up(sum(prices), len(prices), 6), 1, 2)
    return {
        "total_product_count": total,
        "avg_product_price": average,
        "high_price_rate": half_up(count(p[0] for p in rows if p[2] is not None and p[2] >= 100), total, 4),
        "new_product_count": count(p[0] for p in rows if day(p[3]) == d),
    }


def test_product_stats(spark, data):
    df = spark.createDataFrame(data[2], PRODUCTS)
    assert by_dt(metrics.product_daily_stats(df)) == {d: product_day(data[2], d) for d in DAYS}
    asked = ["2023-12-31", DAYS[3], "2024-01-31"]
    assert by_dt(metrics.product_daily_stats(df, asked)) == {d: product_day(data[2], d) for d in asked}


def user_order_day(users, orders, d):
    ordering = {o[1] for o in orders if o[5] == d} - {None}
    active = ordering | ({u[0] for u in users if u[3] == d and day(u[2]) == d} - {None})
    return {"order_user_count": len(ordering), "order_user_rate": half_up(len(ordering), len(active), 4)}


def test_digests(spark, data):
    users, products = spark.createDataFrame(data[1], USERS), spark.createDataFrame(data[2], PRODUCTS)
    for early, late in ((DAYS[1], DAYS[3]), (DAYS[2], DAYS[5]), ("2023-12-31", DAYS[0])):
        for df, key, digest, stats, want in (
            (users, "user_id", history.user_digest, history.user_stats, user_day(data[1], late)),
            (products, "product_id", history.product_digest, history.product_stats, product_day(data[2], late)),
        ):
            first = digest(df.filter(df.dt <= early))
            rest = digest(df.filter((df.dt > early) & (df.dt <= late)))
            assert by_dt(stats(history.merge_digests(first, rest, key), late)) == {late: want}


def test_user_order_stats(spark, data):
    users, orders = spark.createDataFrame(data[1], USERS), spark.createDataFrame(data[0], ORDERS)
    got = by_dt(metrics.user_order_daily_stats(users, orders))
    assert got == {d: user_order_day(data[1], data[0], d) for d in DAYS}
    asked = [DAYS[1], "2024-01-31"]
    got = by_dt(metrics.user_order_daily_stats(users, orders, asked))
    assert got == {d: user_order_day(data[1], data[0], d) for d in asked}


def test_active_user_orders(spark, data):
    users, orders = spark.createDataFrame(data[1], USERS), spark.createDataFrame(data[0], ORDERS)
    got = {(r.dt, r.user_id): (r.order_rows, r.order_amount) for r in metrics.active_user_orders(users, orders).collect()}
    want = {}
    for d in DAYS:
        keys = {o[1] for o in data[0] if o[5] == d} | {u[0] for u in data[1] if u[3] == d and day(u[2]) == d}
        for key in keys:
            mine = [o for o in data[0] if o[5] == d and o[1] == key and key is not None]
            amounts = [o[2] for o in mine if o[2] is not None]
            want[d, key] = (len(mine) or None, sum(amounts) if amounts else None)
    assert got == want


def test_empty_inputs(spark):
    orders, users = spark.createDataFrame([], ORDERS), spark.createDataFrame([], USERS)
    products = spark.createDataFrame([], PRODUCTS)
    assert metrics.order_daily_stats(orders).count() == 0
    for df in (
        metrics.order_daily_stats(orders, ["2024-01-01"]),
        metrics.user_daily_stats(users, ["2024-01-01"]),
        metrics.product_daily_stats(products, ["2024-01-01"]),
        metrics.user_order_daily_stats(users, orders, ["2024-01-01"]),
    ):
        (only,) = by_dt(df).values()
        assert all(v == 0 for v in only.values())


def test_hour_edges(spark):
    def work(at):
        return by_dt(metrics.user_daily_stats(spark.createDataFrame([(1, "n", f"2024-01-01 {at}", "2024-01-01")], USERS)))

    rates = {at: work(at)["2024-01-01"]["workhour_register_rate"] for at in ("08:59:59", "09:00:00", "18:59:59", "19:00:00")}
    assert rates == {"08:59:59": 0, "09:00:00": 1, "18:59:59": 1, "19:00:00": 0}
