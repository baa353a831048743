from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.operators import quality
from layerloom.schemas import ORDER, ORDER_DETAIL, PRODUCT, SOURCE_TABLES, USER, dws_schema
from layerloom.session import scratch_path
from layerloom.sinks import exports, tables
from layerloom.sources import delimited, marks, relational, synthetic, topics

USER_ROWS = [
    (1, "a", datetime(2024, 1, 1, 8), datetime(2024, 1, 10)),
    (2, None, datetime(2024, 1, 2, 9, 30, 15, 500), datetime(2024, 1, 11, 12)),
    (3, "c", None, None),
]


@pytest.fixture
def source(spark):
    return spark.createDataFrame(USER_ROWS, "user_id bigint, username string, register_time timestamp_ntz, update_time timestamp_ntz")


def test_full_import(source, rows):
    got = relational.import_full(source.withColumn("extra", F.lit(1)), USER, "2024-01-12")
    assert [f.name for f in got.schema.fields] == USER.ods_schema().names
    assert rows(got)[1] == (2, None, "2024-01-02 09:30:15", "2024-01-11 12:00:00", None, None, "2024-01-12")


def test_incremental_window_is_half_open(source, rows):
    window = ("2024-01-10 00:00:00", "2024-01-11 12:00:00")
    assert rows(relational.import_incremental(source, USER, *window, "d"), "user_id") == [(1,)]
    text = source.withColumn("update_time", F.substring(F.col("update_time").cast("string"), 1, 19))
    assert rows(relational.import_incremental(text, USER, *window, "d"), "user_id") == [(1,)]
    assert relational.time_window(source, "update_time", marks.FIRST_MARK, "2025-01-01 00:00:00").count() == 2


def test_read_options():
    plain = relational.read_options("jdbc:x", "u_user", user="me")
    assert plain == {"url": "jdbc:x", "dbtable": "u_user", "fetchsize": "10000", "preferTimestampNTZ": "true", "user": "me"}
    split = relational.read_options("jdbc:x", "u_user", "user_id", (1, 900), 8)
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("1", "900", "8")
    with pytest.raises(ValueError):
        relational.read_options("jdbc:x", "u_user", num_partitions=4)


def test_questions_to_the_database():
    assert relational.bounds_query(USER) == "SELECT MIN(user_id) AS low_key, MAX(user_id) AS high_key FROM u_user"
    assert relational.count_query(USER) == "SELECT COUNT(*) AS row_count FROM u_user"
    assert relational.count_query(ORDER, "2024-02-29").endswith(
        "WHERE create_time >= '2024-02-29 00:00:00' AND create_time < '2024-03-01 00:00:00'"
    )


def test_topic_options():
    options = topics.topic_options("h:1", "changes", maxOffsetsPerTrigger="5")
    assert options["startingOffsets"] == "earliest"
    assert options["subscribe"] == "changes"
    assert options["maxOffsetsPerTrigger"] == "5"


def test_marks_move_only_forward_and_per_table(spark, rows):
    store = marks.MarkStore(spark, scratch_path(spark, "marks"))
    assert store.current("u_user") == marks.FIRST_MARK
    store.advance("u_user", "2024-01-02 00:00:00")
    store.advance("u_user", "2024-01-03 00:00:00")
    assert rows(store.marks(["u_user", "o_order"])) == [
        ("o_order", marks.FIRST_MARK),
        ("u_user", "2024-01-03 00:00:00"),
    ]


def test_delimited_lines(spark, rows):
    schema = T.StructType.fromDDL("id int, name string, price decimal(10,2), note string")
    lines = ["1\x01a,b\tc\x012.50\x01", "2\x01\x01\\N\x01\\N", "x\x01\\N\x01bad\x01z", "3\x01only", ""]
    df = spark.createDataFrame([(line, "d") for line in lines], "value string, dt string")
    assert rows(delimited.parse_lines(df, schema)) == [
        (1, "a,b\tc", Decimal("2.50"), "", "d"),
        (2, "", None, None, "d"),
        (3, "only", None, None, "d"),
        (None, None, None, "z", "d"),
        (None, None, None, None, "d"),
    ]


def test_delimited_files_round_trip(spark, rows):
    df = spark.createDataFrame(
        [(1, "", Decimal("1.00"), None, "t", "2024-01-01"), (None, None, None, "t", None, "2024-01-02")],
        "product_id int, product_name string, price decimal(10,2), create_time string, update_time string, dt string",
    )
    path = scratch_path(spark, "text")
    delimited.write_delimited(df, path)
    schema = T.StructType(PRODUCT.source_schema().fields + [T.StructField("dt", T.StringType())])
    got = delimited.read_delimited(spark, path, schema)
    assert got.schema["dt"].dataType == T.StringType()
    assert rows(got) == rows(df)


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "v int, dt string")


SCHEMA = T.StructType().add("v", T.IntegerType()).add("dt", T.StringType())


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_static_and_dynamic_overwrite(spark, rows, fmt):
    path = scratch_path(spark, "table")
    tables.overwrite_found_partitions(frame(spark, (1, "2024-01-01"), (2, "2024-01-02")), path, fmt, spread=True)
    tables.overwrite_found_partitions(frame(spark, (3, "2024-01-02")), path, fmt)
    tables.overwrite_found_partitions(frame(spark).limit(0), path, fmt)
    read = lambda: rows(tables.read_partitions(spark, path, SCHEMA, fmt))
    assert read() == [(1, "2024-01-01"), (3, "2024-01-02")]
    tables.overwrite_partition(frame(spark, (4, "ignored")), path, "2024-01-01", fmt)
    assert read() == [(3, "2024-01-02"), (4, "2024-01-01")]
    tables.overwrite_partition(frame(spark).limit(0), path, "2024-01-01", fmt)
    assert read() == [(3, "2024-01-02")]
    tables.clear_partitions(spark, path, ["2024-01-02"], SCHEMA, fmt)
    assert read() == []


def test_append_and_schema(spark, rows):
    path = scratch_path(spark, "table")
    assert tables.read_partitions(spark, path, SCHEMA).count() == 0
    tables.append_partitions(frame(spark, (1, "2024-01-01")), path)
    tables.append_partitions(frame(spark, (2, "2024-01-01")), path, spread=True)
    assert rows(tables.read_partitions(spark, path, SCHEMA)) == [(1, "2024-01-01"), (2, "2024-01-01")]


def test_orc_is_snappy(spark):
    path = scratch_path(spark, "table")
    tables.overwrite_partition(frame(spark, (1, "d")), path, "2024-01-01", ORDER_DETAIL.detail_format)
    assert any(".snappy.orc" in p.name for p in Path(path).rglob("*.orc"))


def test_publish_and_register(spark, rows):
    path = scratch_path(spark, "table")
    tables.append_partitions(frame(spark, (1, "2024-01-01")), path)
    tables.register_table(spark, "published", path, SCHEMA)
    assert rows(quality.catalog_partitions(spark, "published")) == [("2024-01-01",)]
    tables.append_partitions(frame(spark, (2, "2024-01-02")), path)
    tables.publish_partitions(spark, path, ["2024-01-02"], "published")
    assert Path(path, "dt=2024-01-02", "_SUCCESS").exists()
    assert rows(quality.catalog_partitions(spark, "published")) == [("2024-01-01",), ("2024-01-02",)]
    assert spark.table("published").count() == 2


def test_partition_files(spark, rows):
    path = scratch_path(spark, "table")
    tables.append_partitions(frame(spark, (1, "2024-01-01"), (2, "2024-01-01")).coalesce(1), path)
    tables.publish_partitions(spark, path, ["2024-01-01", "2024-01-03"])
    Path(path, "dt=2024-01-03", "x_tmp").write_text("x")
    Path(path, "dt=2024-01-03", "part-r-0").write_text("x")
    assert rows(quality.partition_files(spark, path), "dt", "data_files") == [("2024-01-01", 1)]
    assert quality.partition_files(spark, path, "2024-01-03").count() == 0
    assert tables.partition_exists(spark, path, "2024-01-03")
    assert not tables.partition_exists(spark, path, "2024-01-02")


def test_reading_days_lists_only_those(spark, rows):
    path = scratch_path(spark, "table")
    tables.append_partitions(frame(spark, (1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")), path)
    some = tables.read_partitions(spark, path, SCHEMA, dts=["2024-01-01", "2024-01-03", "2030-01-01"])
    assert rows(some) == [(1, "2024-01-01"), (3, "2024-01-03")]
    assert not any("dt=2024-01-02" in name for name in some.inputFiles())
    assert tables.read_partitions(spark, path, SCHEMA, dts=["2030-01-01"]).count() == 0


def test_conform_checks_the_type(spark):
    df = spark.createDataFrame([(2**40, "d")], "v bigint, dt string")
    with pytest.raises(PySparkException):
        tables.conform(df, SCHEMA).collect()
    assert tables.conform(df.withColumn("v", F.lit(5)), SCHEMA).schema.names == ["v", "dt"]


def test_exports(spark, rows):
    frames = {}
    for name in exports.EXPORT_COLUMNS:
        schema = dws_schema(name)
        values = [1 if isinstance(f.dataType, T.IntegerType) else Decimal("0.5") for f in schema.fields[:-2]]
        frames[name] = spark.createDataFrame(
            [(*values, "e", d) for d in ("2024-01-03", "2024-01-01", "2024-01-02")], schema
        )
    folder = scratch_path(spark, "export")
    exports.export_csv(frames, folder, "2024-01-02")
    assert rows(exports.export_summary(spark, folder)) == [(n, 2) for n in sorted(frames)]
    (file,) = Path(folder, "dws_order_stats_di").glob("*.csv")
    assert file.read_text() == "2024-01-02,1,0.50\n2024-01-03,1,0.50\n"
    exports.export_csv(frames, folder, "2025-01-01")
    assert rows(exports.export_summary(spark, folder)) == [(n, 0) for n in sorted(frames)]


@pytest.mark.parametrize("make", [synthetic.random_tables, synthetic.updated_tables])
def test_synthetic_tables(spark, rows, make):
    made = make(spark, "2024-01-31", seed=5, users=50, products=20, orders=100, details=300)
    again = make(spark, "2024-01-31", seed=5, users=50, products=20, orders=100, details=300)
    other = make(spark, "2024-01-31", seed=6, users=50, products=20, orders=100, details=300)
    for name, spec in SOURCE_TABLES.items():
        df = made[name]
        assert sorted(df.columns) == sorted(spec.column_names)
        assert rows(df) == rows(again[name].repartition(5))
        assert rows(df) != rows(other[name])
        assert df.select(spec.key).distinct().count() == df.count()
        assert df.filter(F.col("update_time") < F.col(spec.time_column)).isEmpty()
        assert not df.filter(F.col(spec.time_column).isNull() | F.col("update_time").isNull()).count()
    assert {n: df.count() for n, df in made.items()} == {"u_user": 50, "p_product": 20, "o_order": 100, "o_order_detail": 300}
    assert quality.declared_orphans(made, SOURCE_TABLES).isEmpty()
    assert made["o_order"].filter(~F.col("order_status").isin(1, 2, 3)).isEmpty()


def test_synthetic_amounts_match_details(spark):
    from layerloom.operators.rollup import amount_differences

    made = synthetic.updated_tables(spark, "2024-01-31", users=50, products=20, orders=100, details=300)
    off = amount_differences(made["o_order"], made["o_order_detail"], made["p_product"]).filter("difference <> 0")
    assert off.isEmpty()
    share = made["p_product"].filter("update_time > create_time").count() / 20
    assert 0 <= share < 0.6
    days = made["o_order"].select(F.substring("create_time", 1, 10)).distinct().collect()
    assert [r[0] for r in days] == ["2024-01-31"]
    assert ORDER.key in made["o_order"].columns


@pytest.mark.parametrize("text", ["a\u0001b", "a\nb", "\\N"])
def test_text_that_the_layout_cannot_carry_is_an_error(spark, tmp_path, text):
    df = spark.createDataFrame([(text, "2024-01-01")], "name string, dt string")
    with pytest.raises(Exception, match="cannot carry"):
        delimited.write_delimited(df, str(tmp_path / "out"))
