import json
from decimal import Decimal

import pytest

from layerloom.operators.changelog import bad_events, flatten_table, parse_events, rows_without_day
from layerloom.schemas import ORDER, USER
from layerloom.sources.field_list import ingest, read_config, read_short_config, type_by_name

TS = 1704447000000  # 2024-01-05 09:30:00


def event(data, table="u_user", kind="INSERT", database="demo_oltp", ts=TS, **extra):
    return json.dumps({"database": database, "table": table, "type": kind, "ts": ts, "data": data, **extra})


def user(i, name="n", at="2024-01-04 08:00:00"):
    return {"user_id": str(i), "username": name, "register_time": at, "update_time": at}


EVENTS = [
    event([user(1)]),
    event([user(2), user(3)], kind="UPDATE"),
    event([user(4)], table="p_product"),
    event([user(5)], database="other"),
    event([]),
    event(None),
    event([{"username": "no key"}]),
    event([{"user_id": "x7", "username": "bad key"}]),
    event([{"user_id": 8, "extra": {"a": 1}}], kind="DELETE", unknown=[1]),
    '{"database": "demo_oltp", "table": "u_user", "type": "INS',
    "not json",
    "",
    None,
    event([user(9, at="bad")], ts="late"),
]


@pytest.fixture
def parsed(spark):
    return parse_events(spark.createDataFrame([(e,) for e in EVENTS], "value string"))


def test_flatten_all_rows(parsed, rows):
    at = "2024-01-04 08:00:00"
    got = flatten_table(parsed, USER)
    assert got.columns == USER.ods_schema().names
    assert rows(got) == [
        (1, "n", at, at, "INSERT", "2024-01-05 09:30:00", "2024-01-04"),
        (2, "n", at, at, "UPDATE", "2024-01-05 09:30:00", "2024-01-04"),
        (3, "n", at, at, "UPDATE", "2024-01-05 09:30:00", "2024-01-04"),
        (8, None, None, None, "DELETE", "2024-01-05 09:30:00", None),
        (9, "n", "bad", "bad", "INSERT", None, None),
    ]


def test_flatten_first_row_only(parsed, rows):
    got = flatten_table(parsed, USER, rows="first", dt_policy="op_date")
    assert rows(got, "user_id", "dt") == [(1, "2024-01-05"), (2, "2024-01-05"), (8, "2024-01-05"), (9, None)]


def test_dt_policies(parsed):
    run = flatten_table(parsed, USER, dt_policy="run_date", run_date="2024-02-02")
    assert {r.dt for r in run.collect()} == {"2024-02-02"}
    with pytest.raises(ValueError):
        flatten_table(parsed, USER, dt_policy="run_date")
    with pytest.raises(ValueError):
        flatten_table(parsed, USER, dt_policy="x")
    with pytest.raises(ValueError):
        flatten_table(parsed, USER, rows="last")


def test_order_marks(parsed, rows):
    got = flatten_table(parsed, USER, keep_order=True).filter("user_id in (2, 3)")
    assert rows(got, "user_id", "op_ms", "row_pos") == [(2, TS, 0), (3, TS, 1)]


def test_bad_events_are_kept_aside(parsed):
    found = {(str(r.raw), r.reason) for r in bad_events(parsed).collect()}
    # EVENTS[13] has text as its time, which makes the whole event unreadable, or leaves it without a day
    assert {t for t, _ in found} == {EVENTS[5], EVENTS[9], "not json", "", "None", EVENTS[13]}
    assert dict(found)[EVENTS[5]] == "payload"
    assert dict(found)["not json"] == "unroutable"


def test_rows_without_a_day_are_found(spark, parsed):
    lost = rows_without_day(flatten_table(parsed, USER)).collect()
    assert {r.reason for r in lost} == {"row_day"} and len(lost) == 2
    oops = event([user(1)]).replace('"data": [', '"data": "oops", "was": [')
    (bad,) = bad_events(parse_events(spark.createDataFrame([(oops,)], "value string"))).collect()
    assert (bad.raw, bad.reason) == (oops, "payload")


def test_quoted_numbers_become_typed(spark, rows):
    data = [{"order_id": "12", "user_id": "3", "total_amount": "45.678", "order_status": "2", "create_time": "2024-01-01 00:00:00"}]
    parsed = parse_events(spark.createDataFrame([(event(data, table="o_order"),)], "value string"))
    got = flatten_table(parsed, ORDER)
    assert [f.dataType for f in got.schema.fields] == [f.dataType for f in ORDER.ods_schema().fields]
    assert rows(got, "order_id", "total_amount", "order_status", "dt") == [(12, Decimal("45.68"), 2, "2024-01-01")]


def test_binary_values(spark):
    df = spark.createDataFrame([(bytearray(EVENTS[0].encode()),)], "value binary")
    assert flatten_table(parse_events(df), USER).count() == 1


def test_events_are_parsed_once(parsed):
    plan = flatten_table(parsed, USER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


LINE = " u_user | topic | ods_u_user |id:INT:user_id,big:BIGINT:user_id,amount:DECIMAL(12,3):user_id,name:VARCHAR(20):username"


def test_config_line():
    config = read_config(LINE)
    assert (config.table, config.topic, config.target) == ("u_user", "topic", "ods_u_user")
    assert [(f.name, f.dtype, f.json_key) for f in config.fields] == [
        ("id", "int", "user_id"),
        ("big", "bigint", "user_id"),
        ("amount", "decimal(12,3)", "user_id"),
        ("name", "string", "username"),
    ]


def test_config_ingest(parsed, rows):
    got = ingest(parsed, read_config(LINE))
    assert got.columns == ["id", "big", "amount", "name", "op_type", "op_ts", "dt"]
    # No key is declared here, so rows without one stay.
    assert rows(got.filter("id is not null"), "id", "amount", "dt") == [
        (1, Decimal("1.000"), "2024-01-05"),
        (2, Decimal("2.000"), "2024-01-05"),
        (3, Decimal("3.000"), "2024-01-05"),
        (8, Decimal("8.000"), "2024-01-05"),
        (9, Decimal("9.000"), None),
    ]
    assert got.count() == 7
    assert ingest(parsed, read_config(LINE), database=None).count() == 8
    assert ingest(parsed, read_config(LINE), rows="first").count() == 6
    assert [f.dtype for f in read_config("t|k|o|a:BIGINT(20):a,b:bigint unsigned:b,c:INT:c").fields] == ["bigint", "bigint", "int"]


def test_types_from_names():
    names = ["order_id", "order_status", "quantity", "price", "total_amount", "create_time", "username"]
    assert [type_by_name(n) for n in names] == ["INT", "INT", "INT", "DECIMAL(10,2)", "DECIMAL(10,2)", "STRING", "STRING"]
    config = read_short_config("o_order|ods_o_order|order_id, total_amount,create_time", topic="t")
    assert [f.dtype for f in config.fields] == ["int", "decimal(10,2)", "string"]
