"""One entry per operator: ``name -> f(spark, sf_dir) -> DataFrame`` over the shared tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harness.views import change_events, table, table_events, view
from layerloom.functions.times import epoch_ms_text, to_epoch_ms
from layerloom.operators import history, metrics, quality, rollup
from layerloom.operators.changelog import bad_events, flatten_table, parse_events
from layerloom.operators.clean import clean_orders, clean_products, clean_users
from layerloom.operators.merge import merge_table
from layerloom.plans import daily, runlog
from layerloom.plans.validate import validate
from layerloom.schemas import ORDER, ORDER_DETAIL, SOURCE_TABLES, USER
from layerloom.session import scratch_path
from layerloom.sinks.exports import export_csv, export_summary, trend
from layerloom.sinks.tables import overwrite_found_partitions, read_partitions
from layerloom.sources.delimited import line_of, parse_lines
from layerloom.sources.field_list import ingest, read_config, read_short_config
from layerloom.sources.relational import import_full, import_incremental
from layerloom.streaming.cdc import CdcJob, apply_batch, compact_log, read_change_log, replay_day, start_append, start_ingest
from layerloom.streaming.windows import minute_order_stats, with_event_time

ETL_TIME = "2024-02-01 00:00:00"
RUN_DT = "2024-01-15"
EXPORT_SINCE = "2024-01-10"
WINDOW = ("2024-01-10 00:00:00", "2024-01-20 12:30:00")
DAYS = ("2024-01-14", RUN_DT)
FIELD_LINE = "u_user|changes|ods_u_user|id:BIGINT(20):user_id,amount:DECIMAL(12,3):user_id,name:STRING:username,at:DATETIME:register_time"
SHORT_LINE = "u_user|ods_u_user|user_id,username,register_time,update_time"

Query = Callable[[SparkSession, str], DataFrame]


# Detail and metric layers


def dwd_user(spark: SparkSession, sf: str) -> DataFrame:
    return clean_users(view(spark, sf, "ods_u_user"), ETL_TIME)


def dwd_user_rows(spark: SparkSession, sf: str) -> DataFrame:
    return clean_users(view(spark, sf, "ods_u_user_rows"), ETL_TIME)


def dwd_product(spark: SparkSession, sf: str) -> DataFrame:
    return clean_products(view(spark, sf, "ods_p_product"), ETL_TIME)


def dwd_order(spark: SparkSession, sf: str) -> DataFrame:
    return clean_orders(view(spark, sf, "ods_o_order"), ETL_TIME)


def dws_order_stats(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.order_daily_stats(dwd_order(spark, sf), etl_time=ETL_TIME)


def dws_user_stats(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.user_daily_stats(dwd_user(spark, sf), etl_time=ETL_TIME)


def dws_user_stats_repeated(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.user_daily_stats(dwd_user_rows(spark, sf), etl_time=ETL_TIME)


def dws_product_stats(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.product_daily_stats(dwd_product(spark, sf), etl_time=ETL_TIME)


def dws_user_order(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.user_order_daily_stats(dwd_user(spark, sf), dwd_order(spark, sf), etl_time=ETL_TIME)


def _digest_day(df: DataFrame, table: str) -> DataFrame:
    """The metrics of one day from a digest of the days before a cut and one of those since."""
    digest, stats = history.DIGESTS[table], history.STATS[table]
    before = digest(df.filter(F.col("dt") < EXPORT_SINCE))
    since = digest(df.filter(F.col("dt").between(EXPORT_SINCE, RUN_DT)))
    return stats(history.merge_digests(before, since, SOURCE_TABLES[table].key), RUN_DT, ETL_TIME)


def dws_user_stats_digest(spark: SparkSession, sf: str) -> DataFrame:
    return _digest_day(dwd_user_rows(spark, sf), "u_user")


def dws_product_stats_digest(spark: SparkSession, sf: str) -> DataFrame:
    return _digest_day(dwd_product(spark, sf), "p_product")


def dws_order_stats_one_day(spark: SparkSession, sf: str) -> DataFrame:
    """A reported day and one without any row, whose metrics are 0."""
    return metrics.order_daily_stats(dwd_order(spark, sf), [RUN_DT, "2030-01-01"], ETL_TIME)


def active_user_orders(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.active_user_orders(dwd_user(spark, sf), dwd_order(spark, sf))


# Change-log merge


def _merge(name: str, spec: str, **options) -> Query:
    return lambda spark, sf: merge_table(view(spark, sf, name), spec, etl_time=ETL_TIME, **options)


# Change-log flattening


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return parse_events(change_events(table(spark, sf, "events")))


def changelog_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_table(_events(spark, sf), USER)


def changelog_first_row(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_table(_events(spark, sf), USER, rows="first", dt_policy="op_date")


def config_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return ingest(_events(spark, sf), read_config(FIELD_LINE))


def config_ingest_first_row(spark: SparkSession, sf: str) -> DataFrame:
    return ingest(_events(spark, sf), read_short_config(SHORT_LINE), rows="first")


def config_ingest_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return ingest(_events(spark, sf), read_short_config(SHORT_LINE))


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` read as a stream; available data arrives as one micro-batch."""
    source = spark.readStream.schema(table(spark, sf, "events").schema)
    return source.parquet(f"{sf}/events*.parquet")


def stream_changelog_append(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "append")
    raw = change_events(_event_stream(spark, sf)).select("value")
    query = start_append(raw, USER, f"{root}/ods", f"{root}/checkpoint", {"availableNow": True})
    query.awaitTermination()
    return read_partitions(spark, f"{root}/ods", USER.ods_schema()).drop("load")


def _run_batches(spark: SparkSession, parts: list[DataFrame], start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Each part arrives as one micro-batch of a stream, in order.

    The stream is started for each part and goes on from its checkpoint, so a part can have any number of files, and
    the watermark has passed the rows of a part before the next one comes.
    """
    folder = scratch_path(spark, "batches")
    for part in parts:
        part.write.mode("append").parquet(folder)
        start(spark.readStream.schema(parts[0].schema).parquet(folder)).awaitTermination()


def _thirds(spark: SparkSession, sf: str) -> list[DataFrame]:
    events = table(spark, sf, "events")
    return [events.filter(F.col("event_id") % 3 == i) for i in range(3)]


def stream_cdc_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Three micro-batches, each merged into the days that it touches."""
    root = scratch_path(spark, "cdc")
    job = CdcJob(f"{root}/tables", tables=("u_user",), etl_time=ETL_TIME)
    _run_batches(spark, _thirds(spark, sf), lambda part: start_ingest(change_events(part), job, f"{root}/checkpoint", {"availableNow": True}))
    return read_partitions(spark, job.dwd_path(USER), USER.dwd_schema())


def replay_day_result(spark: SparkSession, sf: str) -> DataFrame:
    """Batches only appended, then one day merged by replay, twice."""
    job = CdcJob(scratch_path(spark, "replay"), tables=("u_user",), etl_time=ETL_TIME, merge_each_batch=False)
    for n, part in enumerate(_thirds(spark, sf)):
        apply_batch(change_events(part), job, f"batch-{n}")
    for _ in range(2):
        replay_day(spark, job, RUN_DT)
    return read_partitions(spark, job.dwd_path(USER), USER.dwd_schema())


def _table_rows(spark: SparkSession, job: CdcJob) -> DataFrame:
    """The detail rows of all four tables, one text each."""
    parts = []
    for name in job.tables:
        spec = SOURCE_TABLES[name]
        rows = read_partitions(spark, job.dwd_path(spec), spec.dwd_schema(), spec.detail_format)
        values = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in spec.detail_columns])
        parts.append(rows.select(F.lit(name).alias("table_name"), "dt", values.alias("row")))
    return reduce(DataFrame.unionByName, parts)


def stream_cdc_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Three micro-batches of changes of all four tables, each merged into the stored state of its days."""
    root = scratch_path(spark, "cdc")
    job = CdcJob(f"{root}/tables", etl_time=ETL_TIME, dt_policy="run_date", run_date=RUN_DT)
    _run_batches(spark, _thirds(spark, sf), lambda part: start_ingest(table_events(part), job, f"{root}/checkpoint", {"availableNow": True}))
    return _table_rows(spark, job)


def compacted_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Batches appended and folded into one load in between, then merged by replay."""
    job = CdcJob(scratch_path(spark, "compact"), etl_time=ETL_TIME, dt_policy="run_date", run_date=RUN_DT, merge_each_batch=False)
    for n, part in enumerate(_thirds(spark, sf)):
        apply_batch(table_events(part), job, f"batch-{n}")
        if n:
            compact_log(spark, job, RUN_DT)
    replay_day(spark, job, RUN_DT)
    return _table_rows(spark, job)


def minute_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Closed one-minute windows of a replayed stream."""
    root = scratch_path(spark, "minutes")
    _start_minutes(_event_stream(spark, sf), root).awaitTermination()
    return _minutes(spark, root)


def minute_orders_late(spark: SparkSession, sf: str) -> DataFrame:
    """The same in three micro-batches, the last of which repeats rows of closed windows: they are dropped."""
    events = table(spark, sf, "events")
    half = F.lit("2024-01-15").cast("timestamp_ntz")
    early, late = events.filter(F.col("ts") < half), events.filter(F.col("ts") >= half)
    root = scratch_path(spark, "minutes")
    _run_batches(spark, [early, late, early.filter("event_id % 10 = 0")], lambda part: _start_minutes(part, root))
    return _minutes(spark, root)


def _start_minutes(events: DataFrame, root: str) -> StreamingQuery:
    orders = with_event_time(
        events.select(to_epoch_ms("ts").alias("ts"), F.col("value").cast("decimal(10,2)").alias("total_amount"))
    )
    writer = minute_order_stats(orders).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", f"{root}/windows").option("checkpointLocation", f"{root}/checkpoint")
    return writer.trigger(availableNow=True).start()


def _minutes(spark: SparkSession, root: str) -> DataFrame:
    windows = spark.read.parquet(f"{root}/windows")
    return windows.select(
        epoch_ms_text(F.unix_millis("window_start")).alias("window_start"),
        epoch_ms_text(F.unix_millis("window_end")).alias("window_end"),
        "order_count",
        "order_amount",
    )


# Imports and layouts


def full_import(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as an order source: its timestamp becomes text."""
    source = table(spark, sf, "events").select(
        F.col("event_id").alias("order_id"),
        "user_id",
        F.col("value").alias("total_amount"),
        (F.col("event_id") % 5).alias("order_status"),
        F.col("ts").alias("create_time"),
        F.col("ts").alias("update_time"),
        "props",
    )
    return import_full(source, ORDER, RUN_DT)


def incremental_window(spark: SparkSession, sf: str) -> DataFrame:
    return import_incremental(view(spark, sf, "ods_o_order"), ORDER, *WINDOW, RUN_DT)


def delimited_text_parse(spark: SparkSession, sf: str) -> DataFrame:
    orders = view(spark, sf, "ods_o_order")
    lines = orders.select(line_of(ORDER.column_names).alias("value"), "dt")
    return parse_lines(lines, ORDER.source_schema())


# Roll-up


def _details(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "ods_o_order_detail")


def order_amount_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.order_amounts(_details(spark, sf), view(spark, sf, "ods_p_product"))


def order_amount_recon(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("int").alias("order_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
    )
    return rollup.amount_differences(orders, _details(spark, sf), view(spark, sf, "ods_p_product"))


def detail_order_times(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("int").alias("order_id"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 19).alias("create_time"),
    )
    details = _details(spark, sf).select("detail_id", "order_id", "product_id", "quantity", "create_time", "seq")
    return rollup.details_at_order_time(details, orders)


# Checks


def _ods_frames(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: view(spark, sf, spec.ods_name) for name, spec in SOURCE_TABLES.items()}


def row_count_recon(spark: SparkSession, sf: str) -> DataFrame:
    ods = _ods_frames(spark, sf)
    target = {
        "u_user": dwd_user(spark, sf),
        "p_product": dwd_product(spark, sf),
        "o_order": dwd_order(spark, sf),
        "o_order_detail": ods["o_order_detail"].filter("op_type <> 'DELETE'"),
    }
    return quality.row_count_check([quality.CountPair(name, ods[name], target[name]) for name in ods])


def row_totals(spark: SparkSession, sf: str) -> DataFrame:
    return quality.total_rows(quality.row_counts(_ods_frames(spark, sf)))


def partition_presence(spark: SparkSession, sf: str) -> DataFrame:
    bounds = table(spark, sf, "events").agg(
        F.min("ts").cast("date").alias("first"), F.max("ts").cast("date").alias("last")
    )
    days = bounds.select(F.explode(F.sequence("first", "last").cast("array<string>")).alias("dt"))
    return quality.partition_presence(_ods_frames(spark, sf), days)


def partition_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    overwrite_found_partitions(dwd_order(spark, sf), path, spread=True)
    files = quality.partition_files(spark, path)
    return files.select("dt", (F.col("data_files") > 0).alias("has_files"))


def op_type_census(spark: SparkSession, sf: str) -> DataFrame:
    return quality.op_type_census(_details(spark, sf))


def pk_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(_details(spark, sf), ORDER_DETAIL.key)


def domain_violations(spark: SparkSession, sf: str) -> DataFrame:
    price, status = quality.price_below_zero(), quality.status_out_of_domain()
    checked = {
        "ods_p_product": (view(spark, sf, "ods_p_product"), {"price_below_zero": price}),
        "dwd_p_product": (dwd_product(spark, sf), {"price_below_zero": price}),
        "ods_o_order": (view(spark, sf, "ods_o_order"), {"status_out_of_domain": status}),
        "dwd_o_order": (dwd_order(spark, sf), {"status_out_of_domain": status}),
    }
    counts = [
        quality.violation_counts(df, rules).withColumn("table_name", F.lit(name))
        for name, (df, rules) in checked.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def price_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.violations(view(spark, sf, "ods_p_product"), quality.price_below_zero())


def null_census(spark: SparkSession, sf: str) -> DataFrame:
    counts = [
        quality.null_counts(df, SOURCE_TABLES[name].not_null).withColumn("table_name", F.lit(name))
        for name, df in _ods_frames(spark, sf).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return quality.declared_orphans(_ods_frames(spark, sf), SOURCE_TABLES)


# Run metrics and exports


def _daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = [
        df.groupBy("dt").agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
        for name, df in _ods_frames(spark, sf).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.sync_metrics(_daily_counts(spark, sf), F.col("dt"))


def metric_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.lookup(run_metrics(spark, sf), pattern="sqoop_ods_full_sync_o.*", names=[runlog.SYNC_ROWS])


def metric_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Stored values of every day, replaced from the export day on by new ones."""
    reported = run_metrics(spark, sf)
    stored = reported.withColumn("value", F.lit(-1).cast("bigint"))
    return runlog.merge_metrics(stored, reported.filter(F.col("date") >= EXPORT_SINCE))


def metric_lines(spark: SparkSession, sf: str) -> DataFrame:
    reported = run_metrics(spark, sf)
    return runlog.text_lines(runlog.distinct_lines(reported.unionByName(reported)))


_METRIC_FRAMES: dict[str, Query] = {
    "dws_order_stats_di": dws_order_stats,
    "dws_user_stats_di": dws_user_stats,
    "dws_product_stats_di": dws_product_stats,
    "dws_user_order_basic_di": dws_user_order,
}


def _metric_frames(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: query(spark, sf) for name, query in _METRIC_FRAMES.items()}


def _trend(name: str) -> Query:
    return lambda spark, sf: trend(_METRIC_FRAMES[name](spark, sf), name, EXPORT_SINCE)


def export_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of the four exported CSV files."""
    folder = scratch_path(spark, "export")
    export_csv(_metric_frames(spark, sf), folder, EXPORT_SINCE)
    name = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return spark.read.text(f"{folder}/*").select(name.alias("table_name"), F.col("value").alias("line"))


def export_order_positions(spark: SparkSession, sf: str) -> DataFrame:
    """The place of each day in the exported file of the order metrics."""
    folder = scratch_path(spark, "export")
    export_csv({"dws_order_stats_di": dws_order_stats(spark, sf)}, folder, EXPORT_SINCE)
    lines = spark.read.text(f"{folder}/dws_order_stats_di")  # one file, so ids count its lines
    return lines.select(F.monotonically_increasing_id().alias("position"), F.split("value", ",")[0].alias("dt"))


def export_row_summary(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "export")
    export_csv(_metric_frames(spark, sf), folder, EXPORT_SINCE)
    return export_summary(spark, folder)


def validate_day(spark: SparkSession, sf: str) -> DataFrame:
    """Every row check over the raw views and the detail rows made from them."""
    raw = {"o_order_detail": _details(spark, sf)}
    details = {
        "u_user": dwd_user(spark, sf),
        "p_product": dwd_product(spark, sf),
        "o_order": dwd_order(spark, sf),
        "o_order_detail": raw["o_order_detail"].select("detail_id", "order_id", "product_id", "quantity", "create_time", "dt"),
    }
    return validate(raw, details)


def incremental_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Two windows over one source, with marks stored and read in between."""
    house = daily.Warehouse(spark, scratch_path(spark, "marks"))
    sources = {"o_order": view(spark, sf, "ods_o_order")}
    for now in WINDOW:
        daily.import_changes(house, sources, RUN_DT, now)
    return house.ods("o_order")


def mixed_routes(spark: SparkSession, sf: str) -> DataFrame:
    """Full import, one window read twice, and change batches in one warehouse: rows of each."""
    root = scratch_path(spark, "mixed")
    house, job = daily.Warehouse(spark, root), CdcJob(root, tables=("u_user",), etl_time=ETL_TIME)
    sources = {"u_user": view(spark, sf, "ods_u_user_rows")}
    events = change_events(table(spark, sf, "events"))
    apply_batch(events.filter("src_offset % 2 = 0"), job, "batch-0")
    daily.import_day(house, sources, RUN_DT)
    for store in ("lost", "kept"):  # the first window's mark is lost, so it is read again
        again = replace(house, mark_folder=store)
        daily.import_changes(again, sources, RUN_DT, WINDOW[1])
    apply_batch(events.filter("src_offset % 2 = 1"), job, "batch-1")
    raw = read_change_log(spark, job, USER)
    kind = F.when(F.col("load").startswith("batch"), "change").when(F.col("load") == "full", "full").otherwise("window")
    return raw.groupBy(kind.alias("load_kind"), "dt").agg(F.count(F.lit(1)).alias("row_count"))


def bad_change_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events that give no rows, by reason: cut texts, rows that are no list, no event time."""
    events = table(spark, sf, "events").select("event_id")
    good = '{"database":"demo_oltp","table":"u_user","type":"INSERT","ts":1,"data":[{"user_id":"1"}]}'
    kinds = {1: good[:30], 2: good.replace('[{"user_id":"1"}]', '"oops"'), 3: good.replace('"ts":1,', ""), 4: good.replace('"type":"INSERT",', "")}
    value = F.lit(good)
    for rest, text in kinds.items():
        value = F.when(F.col("event_id") % 11 == rest, F.lit(text)).otherwise(value)
    found = bad_events(parse_events(events.select(value.alias("value"))))
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


def layered_run(spark: SparkSession, sf: str) -> DataFrame:
    """One whole run over the shared tables; its stored metrics without the run times."""
    root = scratch_path(spark, "warehouse")
    daily.run_day(spark, root, _ods_frames(spark, sf), RUN_DT, ETL_TIME)
    stored = daily.Warehouse(spark, root).run_metrics.read()
    return stored.filter(~F.col("metric").isin(runlog.COST_SECONDS, runlog.FLOW_SECONDS))


def layered_run_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The stored order metrics of one whole run."""
    root = scratch_path(spark, "warehouse")
    daily.run_day(spark, root, _ods_frames(spark, sf), RUN_DT, ETL_TIME)
    return daily.Warehouse(spark, root).dws("dws_order_stats_di")


def layered_run_days(spark: SparkSession, sf: str) -> DataFrame:
    """Two days with a snapshot and a window of changed orders each; the first is cleansed again at the end."""
    root = scratch_path(spark, "days")
    house, frames = daily.Warehouse(spark, root), _ods_frames(spark, sf)
    changed = {"o_order": frames["o_order"].withColumn("total_amount", (F.col("total_amount") + 1).cast("decimal(10,2)"))}
    for dt, now in zip(DAYS, WINDOW, strict=True):
        daily.run_day(spark, root, frames, dt, ETL_TIME)
        daily.import_changes(house, changed, dt, now)
        daily.clean_day(house, dt, ETL_TIME)
    daily.clean_day(house, DAYS[0], ETL_TIME)
    daily.backfill_metrics(house, ETL_TIME)
    return house.dws("dws_order_stats_di")


QUERIES: dict[str, Query] = {
    "dwd_user": dwd_user,
    "dwd_product": dwd_product,
    "dwd_order": dwd_order,
    "dws_order_stats": dws_order_stats,
    "dws_order_stats_one_day": dws_order_stats_one_day,
    "dws_user_stats": dws_user_stats,
    "dws_user_stats_repeated": dws_user_stats_repeated,
    "dws_user_stats_digest": dws_user_stats_digest,
    "dws_product_stats": dws_product_stats,
    "dws_product_stats_digest": dws_product_stats_digest,
    "dws_user_order": dws_user_order,
    "active_user_orders": active_user_orders,
    "cdc_merge_user": _merge("ods_user_cdc", "u_user", scope="all"),
    "cdc_merge_user_daily": _merge("ods_user_cdc", "u_user"),
    "cdc_merge_user_tombstone": _merge("ods_user_cdc", "u_user", scope="all", delete_mode="tombstone"),
    "cdc_merge_product": _merge("ods_product_cdc", "p_product"),
    "cdc_merge_order": _merge("ods_order_cdc", "o_order"),
    "cdc_merge_order_keep_null": _merge(
        "ods_order_cdc", "o_order", scope="all", delete_mode="tombstone", null_op="keep"
    ),
    "cdc_merge_order_detail": _merge("ods_o_order_detail", "o_order_detail"),
    "changelog_flatten": changelog_flatten,
    "changelog_first_row": changelog_first_row,
    "config_ingest": config_ingest,
    "config_ingest_first_row": config_ingest_first_row,
    "config_ingest_by_name": config_ingest_by_name,
    "full_import": full_import,
    "incremental_window": incremental_window,
    "delimited_text_parse": delimited_text_parse,
    "order_amount_rollup": order_amount_rollup,
    "order_amount_recon": order_amount_recon,
    "detail_order_times": detail_order_times,
    "row_count_recon": row_count_recon,
    "row_totals": row_totals,
    "partition_presence": partition_presence,
    "partition_files": partition_files,
    "op_type_census": op_type_census,
    "pk_duplicates": pk_duplicates,
    "domain_violations": domain_violations,
    "price_violations": price_violations,
    "null_census": null_census,
    "fk_orphans": fk_orphans,
    "run_metrics": run_metrics,
    "metric_lookup": metric_lookup,
    "metric_upsert": metric_upsert,
    "metric_lines": metric_lines,
    "export_order_trend": _trend("dws_order_stats_di"),
    "export_user_trend": _trend("dws_user_stats_di"),
    "export_product_trend": _trend("dws_product_stats_di"),
    "export_user_order_trend": _trend("dws_user_order_basic_di"),
    "export_lines": export_lines,
    "export_row_summary": export_row_summary,
    "export_order_positions": export_order_positions,
    "validate_day": validate_day,
    "incremental_marks": incremental_marks,
    "mixed_routes": mixed_routes,
    "bad_change_events": bad_change_events,
    "layered_run": layered_run,
    "layered_run_orders": layered_run_orders,
    "layered_run_days": layered_run_days,
    "minute_order_stats": minute_orders,
    "minute_orders_late": minute_orders_late,
    "stream_changelog_append": stream_changelog_append,
    "stream_cdc_merge": stream_cdc_merge,
    "replay_day_result": replay_day_result,
    "stream_cdc_tables": stream_cdc_tables,
    "compacted_replay": compacted_replay,
}
