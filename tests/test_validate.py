"""The checks of a day in one pass, against one aggregate for each check, and the scans of their plan."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerloom.operators import quality, rollup
from layerloom.plans.validate import _checks, _facts, _findings, faults, validate
from layerloom.schemas import SOURCE_TABLES
from layerloom.session import scratch_path

DETAILS = {
    "u_user": ("user_id int, username string, register_time string, dt string", [(1, "a", "t", "d1"), (1, "a", "t", "d2"), (2, None, "t", "d1"), (2, "b", "t", "d1"), (None, "c", None, "d1"), (None, "c", None, "d1")]),
    "p_product": ("product_id int, product_name string, price decimal(10,2), create_time string, dt string", [(1, "p", 2, "t", "d1"), (1, "p", 3, "t", "d2"), (2, "q", -1, "t", "d1"), (3, None, None, "t", "d1")]),
    "o_order": ("order_id int, user_id int, total_amount decimal(10,2), order_status tinyint, create_time string, dt string", [(1, 1, 6, 1, "t", "d1"), (2, 9, 5, 7, "t", "d1"), (3, 9, None, None, "t", "d1"), (3, None, 4, 2, "t", "d1"), (4, 8, 0, 1, "t", "d2")]),
    "o_order_detail": ("detail_id int, order_id int, product_id int, quantity int, create_time string, dt string", [(1, 1, 1, 2, "t", "d1"), (2, 2, 2, 1, "t", "d1"), (2, 7, 7, 1, "t", "d1"), (3, None, 1, 1, "t", "d1"), (4, 5, 3, None, "t", "d1"), (5, 6, 1, 1, "t", "d2")]),
}


def frames(spark, names):
    made = {}
    for name in names:
        shape, rows = DETAILS[name]
        money = {i for i, column in enumerate(shape.split(", ")) if "decimal" in column}
        rows = [tuple(Decimal(v) if i in money and v is not None else v for i, v in enumerate(r)) for r in rows]
        made[name] = spark.createDataFrame(rows, shape)
    return made


def plain(details):
    """Each check by its own aggregate."""
    found = {}
    for name, df in details.items():
        spec = SOURCE_TABLES[name]
        found["repeated_key", name, spec.key] = quality.duplicate_keys(df, spec.key).count()
        for r in quality.null_counts(df, [c for c in spec.not_null if c in df.columns]).collect():
            found["missing_value", name, r["column_name"]] = r["nulls"]
        for column, parent in spec.foreign_keys:
            if parent in details:
                orphans = quality.foreign_key_orphans(df, column, details[parent], SOURCE_TABLES[parent].key)
                found["orphan", name, column] = sum(r["row_count"] for r in orphans.collect())
    if "p_product" in details:
        found["domain", "p_product", "price_below_zero"] = details["p_product"].filter(quality.price_below_zero()).count()
    if "o_order" in details:
        found["domain", "o_order", "status_out_of_domain"] = details["o_order"].filter(quality.status_out_of_domain()).count()
    if {"o_order", "o_order_detail", "p_product"} <= details.keys():
        differing = rollup.amount_differences(details["o_order"], details["o_order_detail"], details["p_product"])
        found["amount", "o_order", "total_amount"] = differing.filter("difference is null or difference <> 0").count()
    return found


def got(details):
    rows = validate({}, details).collect()
    found = {(r["check_name"], r["table_name"], r["detail"]): r["findings"] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("names", [tuple(DETAILS), ("u_user",), ("o_order", "o_order_detail"), ("p_product", "o_order_detail")])
def test_one_pass_equals_single_checks(spark, names):
    details = frames(spark, names)
    assert got(details) == plain(details)


def test_empty_tables_have_findings_of_0(spark):
    details = {name: df.limit(0) for name, df in frames(spark, DETAILS).items()}
    assert got(details) == plain(details) and set(got(details).values()) == {0}
    some = frames(spark, DETAILS)
    some["u_user"] = some["u_user"].limit(0)
    assert got(some) == plain(some)


def test_change_types_are_no_faults(spark):
    raw = {"u_user": spark.createDataFrame([("INSERT",), ("INSERT",), (None,)], "op_type string")}
    rows = validate(raw, {})
    assert sorted((r["detail"] or "", r["findings"]) for r in rows.collect()) == [("", 1), ("INSERT", 2)]
    assert faults(rows).collect() == []


def test_each_table_is_scanned_at_most_twice(spark):
    stored = {}
    for i, (name, df) in enumerate(frames(spark, DETAILS).items()):
        path = scratch_path(spark, f"table{i}")
        df.write.parquet(path)
        stored[name] = spark.read.schema(df.schema).parquet(path)
    plan = validate({}, stored)._jdf.queryExecution().executedPlan().toString()
    scans = [len(re.findall(rf"FileScan parquet [^\n]*/table{i}[^\n]*", plan)) for i in range(len(DETAILS))]
    assert sum(scans) == len(re.findall("FileScan", plan)) and max(scans) <= 2 and scans[2:] == [1, 1]
    assert got(stored) == plain(stored)
    assert validate({}, stored).filter(F.col("findings") < 0).isEmpty()


def test_foreign_keys_of_many_days_meet_in_one_row(spark):
    """What children say about a parent has no day; a parent's own rows keep theirs, so repeats are counted by day."""
    tables = {
        "o_order": spark.createDataFrame([(1, "d1"), (1, "d1"), (1, "d2"), (1, None), (1, None)], "order_id int, dt string"),
        "o_order_detail": spark.createDataFrame([(i, i % 2 + 1, f"d{i}") for i in range(6)], "detail_id int, order_id int, dt string"),
    }
    checks, _ = _checks(tables)
    own = [c for c in checks if c.keys_of == "o_order"]
    facts = _facts("o_order_detail", tables, own, {})
    assert facts.filter("keys_of = 'o_order'").select("key", "dt").distinct().count() == 2
    found = {(r.check_name, r.table_name): r.findings for r in _findings({n: f.select("*", *[F.lit(1).cast(t).alias(c) for c, t in SOURCE_TABLES[n].columns if c not in f.columns]) for n, f in tables.items()}).collect()}
    assert found["repeated_key", "o_order"] == 2 and found["orphan", "o_order_detail"] == 3
