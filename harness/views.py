"""The shared tables in the shape of the raw layer.

Each view is one SELECT that runs unchanged on Spark and in the checking SQL engine, with
deliberate dirt: NULL keys, padded names, negative and missing money, unknown states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.functions.times import to_epoch_ms
from layerloom.schemas import SOURCE_DATABASE

VIEWS: dict[str, tuple[str, str]] = {
    "ods_u_user": (
        "events",
        """
select case when user_id % 41 = 0 then null else cast(user_id as int) end as user_id,
       concat('  user_', cast(user_id as string), ' ') as username,
       concat('2024-01-', lpad(cast(user_id % 30 + 1 as string), 2, '0'), substr(cast(min(ts) as string), 11, 9)) as register_time,
       substr(cast(max(ts) as string), 1, 19) as update_time,
       concat('2024-01-', lpad(cast(user_id % 30 + 1 as string), 2, '0')) as dt
from events group by user_id""",
    ),
    "ods_u_user_rows": (
        "events",
        """
select case when user_id % 41 = 0 then null else cast(user_id as int) end as user_id,
       concat(' user_', cast(user_id as string), '  ') as username,
       substr(cast(ts as string), 1, 19) as register_time,
       substr(cast(ts as string), 1, 19) as update_time,
       substr(cast(ts as string), 1, 10) as dt
from events""",
    ),
    "ods_p_product": (
        "part",
        """
select case when p_partkey % 43 = 0 then null else cast(p_partkey as int) end as product_id,
       concat(' ', p_name, '  ') as product_name,
       case when p_partkey % 53 = 0 then cast(-1.00 as decimal(10,2))
            else cast(cast(p_retailprice as decimal(10,2)) - 850 as decimal(10,2)) end as price,
       concat('2024-01-', lpad(cast(p_partkey % 30 + 1 as string), 2, '0'), ' 09:30:00') as create_time,
       concat('2024-01-', lpad(cast(p_partkey % 30 + 1 as string), 2, '0'), ' 09:30:00') as update_time,
       concat('2024-01-', lpad(cast(p_partkey % 30 + 1 as string), 2, '0')) as dt
from part""",
    ),
    "ods_o_order": (
        "events",
        """
select case when event_id % 101 = 0 then null else cast(event_id as int) end as order_id,
       cast(user_id as int) as user_id,
       case when event_id % 89 = 0 then null
            when event_id % 97 = 0 then cast(-value as decimal(10,2))
            else cast(value as decimal(10,2)) end as total_amount,
       cast(case event_type when 'signup' then 1 when 'purchase' then 2 when 'error' then 3 when 'view' then 0 else 4 end as tinyint) as order_status,
       substr(cast(ts as string), 1, 19) as create_time,
       substr(cast(ts as string), 1, 19) as update_time,
       substr(cast(ts as string), 1, 10) as dt
from events""",
    ),
    "ods_o_order_detail": (
        "lineitem",
        """
select cast((l_orderkey * 8 + l_linenumber) % 2000000000 as int) as detail_id,
       cast(l_orderkey as int) as order_id,
       cast(l_partkey as int) as product_id,
       cast(l_quantity as int) as quantity,
       substr(cast(l_shipdate as string), 1, 19) as create_time,
       substr(cast(l_shipdate as string), 1, 19) as update_time,
       case l_returnflag when 'N' then 'INSERT' when 'R' then 'UPDATE' else 'DELETE' end as op_type,
       substr(cast(l_shipdate as string), 1, 19) as op_ts,
       l_suppkey as seq,
       substr(cast(l_shipdate as string), 1, 10) as dt
from lineitem""",
    ),
    "ods_user_cdc": (
        "events",
        """
select cast(user_id as int) as user_id,
       concat('user_', cast(user_id as string), '_', event_type) as username,
       substr(cast(ts as string), 1, 19) as register_time,
       case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as op_type,
       substr(cast(ts as string), 1, 19) as op_ts,
       event_id as seq,
       substr(cast(ts as string), 1, 10) as dt
from events""",
    ),
    "ods_product_cdc": (
        "lineitem",
        """
select cast(l_partkey as int) as product_id,
       concat('part ', cast(l_suppkey as string), ' ') as product_name,
       case when l_linenumber = 4 then cast(-1.50 as decimal(10,2))
            when l_linenumber = 6 then null
            else cast(cast(l_quantity as decimal(10,2)) * 3 as decimal(10,2)) end as price,
       substr(cast(l_shipdate as string), 1, 19) as create_time,
       case l_returnflag when 'N' then 'INSERT' when 'R' then 'UPDATE' else 'DELETE' end as op_type,
       substr(cast(l_shipdate as string), 1, 19) as op_ts,
       l_orderkey * 8 + l_linenumber as seq,
       substr(cast(l_shipdate as string), 1, 10) as dt
from lineitem""",
    ),
    "ods_order_cdc": (
        "lineitem",
        """
select cast(l_orderkey as int) as order_id,
       cast(l_suppkey as int) as user_id,
       case when l_linenumber = 3 then cast(-l_extendedprice as decimal(10,2))
            when l_linenumber = 5 then null
            else cast(l_extendedprice as decimal(10,2)) end as total_amount,
       cast(l_linenumber % 6 as tinyint) as order_status,
       substr(cast(l_shipdate as string), 1, 19) as create_time,
       case when l_linenumber = 7 then null
            when l_returnflag = 'N' then 'INSERT' when l_returnflag = 'R' then 'UPDATE' else 'DELETE' end as op_type,
       substr(cast(l_shipdate as string), 1, 19) as op_ts,
       l_partkey as seq,
       substr(cast(l_shipdate as string), 1, 10) as dt
from lineitem""",
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, select = VIEWS[name]
    return spark.sql(select.replace(f"from {base}", f"from {{{base}}}"), **{base: table(spark, sf_dir, base)})


def with_views(names: list[str], ctes: list[tuple[str, str]], final: str) -> str:
    """A WITH query: the named views first, then further steps, then the final SELECT."""
    steps = [(n, VIEWS[n][1]) for n in names] + ctes
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in steps) + f"\n{final}"


def change_events(events: DataFrame) -> DataFrame:
    """Change-log messages made from ``events``: one JSON text per event.

    'view' events belong to another table, every tenth event carries a second row, every
    fiftieth text is cut off, every 75th event has no rows and every 60th row no key.
    """
    ts = F.substring(F.col("ts").cast("string"), 1, 19)
    no_key = F.col("event_id") % 60 == 30
    user = F.when(no_key, F.lit("none")).otherwise(F.col("user_id").cast("string"))
    first = F.create_map(
        F.lit("user_id"), user,
        F.lit("username"), F.concat(F.lit("user_"), F.col("user_id").cast("string")),
        F.lit("register_time"), ts,
        F.lit("update_time"), ts,
    )
    second = F.create_map(
        F.lit("user_id"), (F.col("user_id") + 100_000).cast("string"),
        F.lit("username"), F.lit("second"),
        F.lit("register_time"), ts,
    )
    two = F.col("event_id") % 10 == 0
    none = F.col("event_id") % 75 == 0
    rows = F.when(none, F.array().cast("array<map<string,string>>"))
    rows = rows.when(two, F.array(first, second)).otherwise(F.array(first))
    kind = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE")
    message = F.to_json(
        F.struct(
            rows.alias("data"),
            F.lit(SOURCE_DATABASE).alias("database"),
            F.when(F.col("event_type") == "view", "p_product").otherwise("u_user").alias("table"),
            kind.otherwise("UPDATE").alias("type"),
            to_epoch_ms("ts").alias("ts"),
        )
    )
    cut = F.col("event_id") % 50 == 7
    value = F.when(cut, F.substring(message, 1, 30)).otherwise(message)
    return events.select(value.alias("value"), F.col("event_id").alias("src_offset"))


def table_events(events: DataFrame) -> DataFrame:
    """Change-log messages for all four tables, one row each, dealt by ``event_id``; keys repeat, so rows get several versions."""
    text = lambda c: c.cast("string")
    ts = F.substring(text(F.col("ts")), 1, 19)
    i = F.col("event_id")
    amount = text(F.when(i % 9 == 0, -F.col("value")).otherwise(F.col("value")).cast("decimal(10,2)"))
    shapes = {
        "u_user": {"user_id": text(F.col("user_id")), "username": F.col("event_type"), "register_time": ts, "update_time": ts},
        "p_product": {"product_id": text(i % 500), "product_name": F.col("event_type"), "price": amount, "create_time": ts, "update_time": ts},
        "o_order": {"order_id": text(i % 700), "user_id": text(F.col("user_id")), "total_amount": amount, "order_status": text(i % 5), "create_time": ts, "update_time": ts},
        "o_order_detail": {"detail_id": text(i % 900), "order_id": text(i % 700), "product_id": text(i % 500), "quantity": text(i % 7), "create_time": ts, "update_time": ts},
    }
    row, name = None, None
    for n, (table_name, columns) in enumerate(shapes.items()):
        fields = F.create_map(*[x for k, v in columns.items() for x in (F.lit(k), v)])
        row = F.when(i % 4 == n, fields) if row is None else row.when(i % 4 == n, fields)
        name = F.when(i % 4 == n, table_name) if name is None else name.when(i % 4 == n, table_name)
    kind = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    event = F.struct(F.array(row).alias("data"), F.lit(SOURCE_DATABASE).alias("database"), name.alias("table"), kind.alias("type"), to_epoch_ms("ts").alias("ts"))
    return events.select(F.to_json(event).alias("value"), i.alias("src_offset"))
