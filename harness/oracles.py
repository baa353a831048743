"""Plain SQL for the registered queries, written from the metric definitions.

The SQL states each result directly (distinct counts per day, range joins over the history,
ranked rows), not the way the Spark queries reach it.
"""

from __future__ import annotations

from harness.spark_queries import DAYS, ETL_TIME, EXPORT_SINCE, RUN_DT, WINDOW
from harness.views import with_views

_TAIL = f"'mysql_demo_oltp' as data_source, '{ETL_TIME}' as etl_time, dt"


def _time(column: str) -> str:
    return f"strftime(try_cast({column} as timestamp), '%Y-%m-%d %H:%M:%S')"


def _scaled(whole: str, scale: int, dtype: str) -> str:
    unit = {2: "0.01", 4: "0.0001"}[scale]
    return f"cast(cast({whole} as decimal(18,0)) * {unit} as {dtype})"


def _ratio(num: str, den: str, scale: int, dtype: str, factor: int) -> str:
    """num * factor / den rounded half-up on integers, 0 for an empty denominator."""
    whole = f"(cast({num} as hugeint) * {2 * factor} + {den}) // (2 * {den})"
    return f"case when {den} = 0 then 0 else {_scaled(whole, scale, dtype)} end"


def _rate(num: str, den: str) -> str:
    return f"cast({_ratio(num, den, 4, 'decimal(5,4)', 10_000)} as decimal(5,4))"


def _money(num_cents: str, den: str) -> str:
    return f"cast({_ratio(num_cents, den, 2, 'decimal(16,2)', 1)} as decimal(16,2))"


def _dwd_user(source: str) -> str:
    return (
        f"select user_id, trim(username) as username, {_time('register_time')} as register_time, {_TAIL} "
        f"from {source} where user_id is not null"
    )


DWD_USER = _dwd_user("ods_u_user")
DWD_PRODUCT = (
    "select product_id, trim(product_name) as product_name, "
    "cast(case when price < 0 then 0 else price end as decimal(10,2)) as price, "
    f"{_time('create_time')} as create_time, {_TAIL} from ods_p_product where product_id is not null"
)
DWD_ORDER = (
    "select order_id, user_id, "
    "cast(case when total_amount < 0 or total_amount is null then 0 else total_amount end as decimal(10,2)) "
    "as total_amount, "
    "cast(case when order_status in (1, 2, 3) then order_status else -1 end as tinyint) as order_status, "
    f"{_time('create_time')} as create_time, {_TAIL} from ods_o_order where order_id is not null"
)

_ETL = f"'{ETL_TIME}' as etl_time"


def _order_stats(days: str) -> str:
    """Metrics per day of ``days`` from ``dwd``; a day without rows gives zeros."""
    return f"""
select n as total_order_count, {_scaled("coalesce(cents, 0)", 2, "decimal(16,2)")} as total_order_amount,
       {_money("cents", "n")} as avg_order_amount, valid as valid_order_count,
       {_rate("valid", "n")} as valid_order_rate, {_rate("night", "n")} as night_order_rate,
       {_money("cents", "users")} as per_user_amount, {_ETL}, dt
from (select d.dt, count(distinct order_id) as n, cast(sum(total_amount) * 100 as hugeint) as cents,
             count(distinct order_id) filter (order_status = 1) as valid,
             count(distinct order_id) filter (create_time[12:13] >= '18') as night,
             count(distinct user_id) as users
      from ({days}) d left join dwd using (dt) group by d.dt)"""


_DAY_OF = "cast({0} as timestamp)::date = cast({1} as date)"


def _user_stats() -> str:
    new = _DAY_OF.format("register_time", "d.dt")
    return f"""
select fresh as new_user_count, total as total_user_count, {_rate("working", "fresh")} as workhour_register_rate,
       {_ETL}, dt
from (select d.dt, count(distinct user_id) as total, count(distinct user_id) filter ({new}) as fresh,
             count(distinct user_id) filter ({new} and register_time[12:13] in
               ('09', '10', '11', '12', '13', '14', '15', '16', '17', '18')) as working
      from (select distinct dt from dwd) d join dwd on dwd.dt <= d.dt group by d.dt)"""


def _product_stats() -> str:
    six = "(cents * 20000 + priced) // (2 * priced)"
    average = _scaled(f"({six} + 5000) // 10000", 2, "decimal(10,2)")
    return f"""
select total as total_product_count,
       cast(case when total = 0 then 0 else {average} end as decimal(10,2)) as avg_product_price,
       {_rate("high", "total")} as high_price_rate, fresh as new_product_count, {_ETL}, dt
from (select d.dt, count(distinct product_id) as total, cast(sum(price) * 100 as hugeint) as cents,
             count(price) as priced, count(distinct product_id) filter (price >= 100) as high,
             count(distinct product_id) filter ({_DAY_OF.format("create_time", "d.dt")}) as fresh
      from (select distinct dt from dwd) d join dwd on dwd.dt <= d.dt group by d.dt)"""


_ACTIVE = f"""
select dt, user_id from dwd_order
union
select dt, user_id from dwd_user where {_DAY_OF.format("register_time", "dt")}"""


def _user_order() -> str:
    return f"""
select ordering as order_user_count, {_rate("ordering", "active")} as order_user_rate, {_ETL}, dt
from (select d.dt, count(distinct o.user_id) as ordering, count(distinct a.user_id) as active
      from (select dt from dwd_order union select dt from dwd_user) d
      left join active a using (dt) left join dwd_order o on o.dt = a.dt and o.user_id = a.user_id
      group by d.dt)"""


_CROSS = [("dwd_user", DWD_USER), ("dwd_order", DWD_ORDER), ("active", _ACTIVE)]

DWS = {
    "dws_order_stats_di": with_views(["ods_o_order"], [("dwd", DWD_ORDER)], _order_stats("select distinct dt from dwd")),
    "dws_user_stats_di": with_views(["ods_u_user"], [("dwd", DWD_USER)], _user_stats()),
    "dws_product_stats_di": with_views(["ods_p_product"], [("dwd", DWD_PRODUCT)], _product_stats()),
    "dws_user_order_basic_di": with_views(["ods_u_user", "ods_o_order"], _CROSS, _user_order()),
}
_ONE_DAY = f"select * from (values ('{RUN_DT}'), ('2030-01-01')) v(dt)"


def _latest(
    source: str, key: str, columns: dict[str, str], scope: str = "dt", tombstone: bool = False, keep_null: bool = False
) -> str:
    """Ranked rows; equal order marks are decided by the greatest other columns."""
    keys = f"dt, {key}" if scope == "dt" else key
    others = [c for c in columns if c != key] + ["op_type"] + ([] if scope == "dt" else ["dt"])
    ranking = ", ".join(f"{c} desc nulls last" for c in ["op_ts", "seq", *others])
    live = "(op_type is null or op_type <> 'DELETE')"
    before, after = ("true", live) if tombstone else (live, "true")
    nulls = "true" if keep_null else "op_type is not null"
    selected = ", ".join(f"{expr} as {name}" for name, expr in columns.items())
    return with_views(
        [source],
        [
            (
                "ranked",
                f"select *, row_number() over (partition by {keys} order by {ranking}) as rn "
                f"from {source} where {before} and {nulls}",
            )
        ],
        f"select {selected}, {_TAIL} from ranked where rn = 1 and {after}",
    )


_USER = {"user_id": "user_id", "username": "username", "register_time": "register_time"}
_PRODUCT = {
    "product_id": "product_id",
    "product_name": "product_name",
    "price": "cast(case when price < 0 then 0 else price end as decimal(10,2))",
    "create_time": "create_time",
}
_ORDER = {
    "order_id": "order_id",
    "user_id": "user_id",
    "total_amount": "cast(case when total_amount < 0 then 0 else total_amount end as decimal(10,2))",
    "order_status": "cast(case when order_status in (1, 2, 3) then order_status else -1 end as tinyint)",
    "create_time": "create_time",
}
_DETAIL = {c: c for c in ("detail_id", "order_id", "product_id", "quantity", "create_time")}

# The rows the change-log messages hold, straight from ``events``.
_OP = "case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end"
_TS = "substr(cast(ts as string), 1, 19)"
_SENT = "event_type <> 'view' and event_id % 50 <> 7 and event_id % 75 <> 0"
_FIRST_ROWS = (
    f"select case when event_id % 60 = 30 then null else cast(user_id as int) end as user_id, "
    f"concat('user_', cast(user_id as string)) as username, {_TS} as register_time, {_TS} as update_time, "
    f"{_OP} as op_type, {_TS} as op_ts, substr({_TS}, 1, 10) as dt, event_id as seq, 0 as pos "
    f"from events where {_SENT}"
)
_ALL_ROWS = (
    f"{_FIRST_ROWS} union all "
    f"select cast(user_id + 100000 as int), 'second', {_TS}, null, {_OP}, {_TS}, substr({_TS}, 1, 10), event_id, 1 "
    f"from events where {_SENT} and event_id % 10 = 0"
)
_RAW_USER = "user_id, username, register_time, update_time, op_type, op_ts, dt"
_FLATTEN = f"select {_RAW_USER} from ({_ALL_ROWS}) where user_id is not null"

_ALL_ODS = ["ods_u_user", "ods_p_product", "ods_o_order", "ods_o_order_detail"]
_TABLES = {v: v.removeprefix("ods_") for v in _ALL_ODS}
_DAILY = " union all ".join(
    f"select '{t}' as table_name, dt, count(*) as n from {v} group by dt" for v, t in _TABLES.items()
)
_VALIDATE = """
select 'op_type' as check_name, 'o_order_detail' as table_name, op_type as detail, count(*) as findings from ods_o_order_detail group by op_type
union all select 'repeated_key', 'u_user', 'user_id', (select count(*) from (select 1 from dwd_u group by dt, user_id having count(*) > 1))
union all select 'repeated_key', 'p_product', 'product_id', (select count(*) from (select 1 from dwd_p group by dt, product_id having count(*) > 1))
union all select 'repeated_key', 'o_order', 'order_id', (select count(*) from (select 1 from dwd_o group by dt, order_id having count(*) > 1))
union all select 'repeated_key', 'o_order_detail', 'detail_id', (select count(*) from (select 1 from dwd_d group by dt, detail_id having count(*) > 1))
union all select 'domain', 'p_product', 'price_below_zero', (select count(*) from dwd_p where price < 0)
union all select 'domain', 'o_order', 'status_out_of_domain', (select count(*) from dwd_o where order_status not in (1, 2, 3, -1))
union all select 'missing_value', 'u_user', c, (select count(*) from dwd_u where case c when 'user_id' then user_id is null when 'username' then username is null else register_time is null end) from (values ('user_id'), ('username'), ('register_time')) t(c)
union all select 'missing_value', 'p_product', c, (select count(*) from dwd_p where case c when 'product_id' then product_id is null when 'product_name' then product_name is null when 'price' then price is null else create_time is null end) from (values ('product_id'), ('product_name'), ('price'), ('create_time')) t(c)
union all select 'missing_value', 'o_order', c, (select count(*) from dwd_o where case c when 'order_id' then order_id is null when 'user_id' then user_id is null when 'total_amount' then total_amount is null when 'order_status' then order_status is null else create_time is null end) from (values ('order_id'), ('user_id'), ('total_amount'), ('order_status'), ('create_time')) t(c)
union all select 'missing_value', 'o_order_detail', c, (select count(*) from dwd_d where case c when 'detail_id' then detail_id is null when 'order_id' then order_id is null when 'product_id' then product_id is null when 'quantity' then quantity is null else create_time is null end) from (values ('detail_id'), ('order_id'), ('product_id'), ('quantity'), ('create_time')) t(c)
union all select 'orphan', 'o_order', 'user_id', (select count(*) from dwd_o where user_id is not null and user_id not in (select user_id from dwd_u where user_id is not null))
union all select 'orphan', 'o_order_detail', 'order_id', (select count(*) from dwd_d where order_id is not null and order_id not in (select order_id from dwd_o where order_id is not null))
union all select 'orphan', 'o_order_detail', 'product_id', (select count(*) from dwd_d where product_id is not null and product_id not in (select product_id from dwd_p where product_id is not null))
union all select 'amount', 'o_order', 'total_amount', (select count(*) from booked full join rolled using (order_id) where coalesce(total_amount, 0) <> coalesce(order_amount, 0))"""
_METRIC_ROWS = """
select 'data_warehouse_sync_rows' as metric, 'sqoop_ods_full_sync_' || table_name as business,
       cast(n as bigint) as value, dt as date from daily
union all
select 'data_warehouse_sync_total_rows', 'sqoop_ods_full_sync', cast(sum(n) as bigint), dt from daily group by dt
union all
select 'data_warehouse_success_rate', 'sqoop_ods_full_sync', cast(1 as bigint), dt from daily group by dt"""


def _metrics(final: str) -> str:
    return with_views(_ALL_ODS, [("daily", _DAILY), ("m", _METRIC_ROWS)], final)


def _counts(pairs: dict[str, str], name: str) -> str:
    return " union all ".join(f"select '{k}' as {name}, {q}" for k, q in pairs.items())


_RECON = " union all ".join(
    f"select '{t}' as table_name, (select count(*) from {v}) as src, (select count(*) from {v} where {kept}) as tgt"
    for (v, t), kept in zip(
        _TABLES.items(),
        ["user_id is not null", "product_id is not null", "order_id is not null", "op_type <> 'DELETE'"],
        strict=True,
    )
)

_TRENDS = {
    "dws_order_stats_di": "dt, total_order_count, total_order_amount",
    "dws_user_stats_di": "dt, new_user_count, total_user_count",
    "dws_product_stats_di": "dt, total_product_count, avg_product_price, high_price_rate, new_product_count",
    "dws_user_order_basic_di": "dt, order_user_count, order_user_rate",
}


def _trend(name: str) -> str:
    return f"select {_TRENDS[name]} from ({DWS[name]}) where dt >= '{EXPORT_SINCE}'"


def _lines(name: str) -> str:
    text = ", ".join(f"cast({c.strip()} as varchar)" for c in _TRENDS[name].split(","))
    return f"select '{name}' as table_name, concat_ws(',', {text}) as line from ({_trend(name)})"


_LINES = " union all ".join(_lines(n) for n in _TRENDS)
_EXPORTED = " union all ".join(f"select '{n}' as table_name" for n in _TRENDS)


def _nulls() -> str:
    columns = {
        "ods_u_user": ("user_id", "username", "register_time", "update_time"),
        "ods_p_product": ("product_id", "product_name", "price", "create_time", "update_time"),
        "ods_o_order": ("order_id", "user_id", "total_amount", "order_status", "create_time", "update_time"),
        "ods_o_order_detail": ("detail_id", "order_id", "product_id", "quantity", "create_time", "update_time"),
    }
    return " union all ".join(
        f"select '{_TABLES[v]}' as table_name, '{c}' as column_name, count(*) filter ({c} is null) as nulls from {v}"
        for v, cs in columns.items()
        for c in cs
    )


def _orphans(child: str, column: str, parent: str, key: str) -> str:
    return (
        f"select '{_TABLES[child]}' as child_table, '{column}' as column_name, {column} as key_value, "
        f"count(*) as row_count from {child} c where {column} is not null "
        f"and not exists (select 1 from {parent} p where p.{key} = c.{column}) group by {column}"
    )


_ROLLUP = (
    "select order_id, count(*) as detail_count, cast(sum(price * quantity) as decimal(16,2)) as order_amount "
    "from ods_o_order_detail join ods_p_product using (product_id) group by order_id"
)
_LAYERED_DWD = DWD_ORDER.replace(", dt from", f", '{RUN_DT}' as dt from")
_STEPS = ("ods_sync", "row_check", "partition_check", "dwd_clean", "dws_agg")
_RUN_ROWS = " union all ".join(
    f"select 'data_warehouse_step_status' as metric, 'full_data_governance_flow_{s}' as business, 1 as value"
    for s in _STEPS
)

_DAYS_RAW = (
    "select order_id, user_id, cast(total_amount + case when update_time >= lo and update_time < hi then 1 else 0 end as decimal(10,2)) as total_amount, "
    "order_status, create_time, update_time, d.dt from (select * exclude (dt) from ods_o_order) cross join "
    f"(values ('{DAYS[0]}', '', '{WINDOW[0]}'), ('{DAYS[1]}', '{WINDOW[0]}', '{WINDOW[1]}')) d(dt, lo, hi)"
)


def _table_rows() -> str:
    """The latest change of each key of the four tables that ``table_events`` makes, deletes left out before ranking."""
    floor = "case when amount < 0 then cast(0 as decimal(10,2)) else amount end"
    shapes = {
        "u_user": ("user_id", "user_id, event_type, made_at"),
        "p_product": ("event_id % 500", f"event_id % 500, event_type, {floor}, made_at"),
        "o_order": ("event_id % 700", f"event_id % 700, user_id, {floor}, case when event_id % 5 in (1, 2, 3) then event_id % 5 else -1 end, made_at"),
        "o_order_detail": ("event_id % 900", "event_id % 900, event_id % 700, event_id % 500, event_id % 7, made_at"),
    }
    parts = [
        f"select '{name}' as table_name, '{RUN_DT}' as dt, concat_ws('|', {columns}) as row from changes "
        f"where event_id % 4 = {n} qualify row_number() over (partition by {key} order by ts desc, event_id desc) = 1"
        for n, (name, (key, columns)) in enumerate(shapes.items())
    ]
    changes = (
        "select *, substr(cast(ts as varchar), 1, 19) as made_at, cast(case when event_id % 9 = 0 then -value else value end as decimal(10,2)) as amount "
        "from events where event_type <> 'error'"
    )
    return f"with changes as ({changes}) " + " union all ".join(f"(select * from ({p}))" for p in parts)


ORACLES: dict[str, str] = {
    "dwd_user": with_views(["ods_u_user"], [], DWD_USER),
    "dwd_product": with_views(["ods_p_product"], [], DWD_PRODUCT),
    "dwd_order": with_views(["ods_o_order"], [], DWD_ORDER),
    "dws_order_stats": DWS["dws_order_stats_di"],
    "dws_order_stats_one_day": with_views(["ods_o_order"], [("dwd", DWD_ORDER)], _order_stats(_ONE_DAY)),
    "dws_user_stats": DWS["dws_user_stats_di"],
    "dws_user_stats_repeated": with_views(
        ["ods_u_user_rows"], [("dwd", _dwd_user("ods_u_user_rows"))], _user_stats()
    ),
    "dws_user_stats_digest": "select * from ("
    + with_views(["ods_u_user_rows"], [("dwd", _dwd_user("ods_u_user_rows"))], _user_stats())
    + f") where dt = '{RUN_DT}'",
    "dws_product_stats": DWS["dws_product_stats_di"],
    "dws_product_stats_digest": f"select * from ({DWS['dws_product_stats_di']}) where dt = '{RUN_DT}'",
    "dws_user_order": DWS["dws_user_order_basic_di"],
    "active_user_orders": with_views(
        ["ods_u_user", "ods_o_order"],
        _CROSS,
        "select a.user_id, case when count(o.dt) = 0 then null else count(o.dt) end as order_rows, "
        "cast(sum(o.total_amount) as decimal(16,2)) as order_amount, a.dt "
        "from active a left join dwd_order o on a.user_id = o.user_id and o.dt = a.dt group by a.dt, a.user_id",
    ),
    "cdc_merge_user": _latest("ods_user_cdc", "user_id", _USER, "all"),
    "cdc_merge_user_daily": _latest("ods_user_cdc", "user_id", _USER),
    "cdc_merge_user_tombstone": _latest("ods_user_cdc", "user_id", _USER, "all", tombstone=True),
    "cdc_merge_product": _latest("ods_product_cdc", "product_id", _PRODUCT),
    "cdc_merge_order": _latest("ods_order_cdc", "order_id", _ORDER),
    "cdc_merge_order_keep_null": _latest(
        "ods_order_cdc", "order_id", _ORDER, "all", tombstone=True, keep_null=True
    ),
    "cdc_merge_order_detail": _latest("ods_o_order_detail", "detail_id", _DETAIL),
    "changelog_flatten": _FLATTEN,
    "changelog_first_row": f"select {_RAW_USER} from ({_FIRST_ROWS}) where user_id is not null",
    "config_ingest": (
        "select user_id as id, cast(user_id as decimal(12,3)) as amount, username as name, "
        f"register_time as at, op_type, op_ts, dt from ({_ALL_ROWS})"
    ),
    "config_ingest_first_row": f"select {_RAW_USER} from ({_FIRST_ROWS})",
    "config_ingest_by_name": f"select {_RAW_USER} from ({_ALL_ROWS})",
    "full_import": (
        "select cast(event_id as int) as order_id, cast(user_id as int) as user_id, "
        "cast(value as decimal(10,2)) as total_amount, cast(event_id % 5 as tinyint) as order_status, "
        f"{_TS} as create_time, {_TS} as update_time, cast(null as varchar) as op_type, "
        f"cast(null as varchar) as op_ts, '{RUN_DT}' as dt from events"
    ),
    "incremental_window": with_views(
        ["ods_o_order"],
        [],
        "select order_id, user_id, total_amount, order_status, create_time, update_time, "
        f"cast(null as varchar) as op_type, cast(null as varchar) as op_ts, '{RUN_DT}' as dt "
        f"from ods_o_order where update_time >= '{WINDOW[0]}' and update_time < '{WINDOW[1]}'",
    ),
    "delimited_text_parse": with_views(["ods_o_order"], [], "select * from ods_o_order"),
    "order_amount_rollup": with_views(["ods_o_order_detail", "ods_p_product"], [], _ROLLUP),
    "order_amount_recon": with_views(
        ["ods_o_order_detail", "ods_p_product"],
        [
            ("rolled", _ROLLUP),
            (
                "booked",
                "select cast(o_orderkey as int) as order_id, "
                "cast(sum(cast(o_totalprice as decimal(10,2))) as decimal(16,2)) as total_amount "
                "from orders group by o_orderkey",
            ),
        ],
        "select order_id, total_amount, order_amount, "
        "cast(coalesce(total_amount, 0) - coalesce(order_amount, 0) as decimal(16,2)) as difference "
        "from booked full join rolled using (order_id)",
    ),
    "detail_order_times": with_views(
        ["ods_o_order_detail"],
        [],
        "select d.detail_id, d.order_id, d.product_id, d.quantity, d.seq, "
        "substr(cast(o.o_orderdate as string), 1, 19) as create_time "
        "from ods_o_order_detail d join orders o on o.o_orderkey = d.order_id",
    ),
    "row_count_recon": with_views(
        _ALL_ODS,
        [("counts", _RECON), ("diffs", "select *, abs(tgt - src) / cast(src as double) * 100 as diff_pct from counts")],
        "select table_name, src, tgt, diff_pct, diff_pct < 0.1 as passed from diffs",
    ),
    "row_totals": with_views(_ALL_ODS, [("daily", _DAILY)], "select cast(sum(n) as bigint) as total_rows from daily"),
    "partition_presence": with_views(
        _ALL_ODS,
        [
            ("daily", _DAILY),
            (
                "days",
                "select strftime(unnest(generate_series(min(ts)::date, max(ts)::date, interval 1 day)), "
                "'%Y-%m-%d') as dt from events",
            ),
            ("expected", "select table_name, dt from days, (select distinct table_name from daily)"),
        ],
        "select table_name, e.dt, d.n is not null as present "
        "from expected e left join daily d using (table_name, dt)",
    ),
    "partition_files": with_views(
        ["ods_o_order"], [("dwd", DWD_ORDER)], "select distinct dt, true as has_files from dwd"
    ),
    "op_type_census": with_views(
        ["ods_o_order_detail"],
        [],
        "select dt, op_type, count(*) as row_count from ods_o_order_detail group by dt, op_type",
    ),
    "pk_duplicates": with_views(
        ["ods_o_order_detail"],
        [],
        "select dt, detail_id, count(*) as row_count from ods_o_order_detail "
        "group by dt, detail_id having count(*) > 1",
    ),
    "domain_violations": with_views(
        ["ods_p_product", "ods_o_order"],
        [("dwd_p_product", DWD_PRODUCT), ("dwd_o_order", DWD_ORDER)],
        _counts(
            {
                t: f"'{rule}' as rule, count(*) filter ({test}) as violations from {t}"
                for t, rule, test in (
                    ("ods_p_product", "price_below_zero", "price < 0"),
                    ("dwd_p_product", "price_below_zero", "price < 0"),
                    ("ods_o_order", "status_out_of_domain", "order_status not in (1, 2, 3, -1)"),
                    ("dwd_o_order", "status_out_of_domain", "order_status not in (1, 2, 3, -1)"),
                )
            },
            "table_name",
        ),
    ),
    "price_violations": with_views(["ods_p_product"], [], "select * from ods_p_product where price < 0"),
    "null_census": with_views(_ALL_ODS, [], _nulls()),
    "fk_orphans": with_views(
        _ALL_ODS,
        [],
        " union all ".join(
            [
                _orphans("ods_o_order", "user_id", "ods_u_user", "user_id"),
                _orphans("ods_o_order_detail", "order_id", "ods_o_order", "order_id"),
                _orphans("ods_o_order_detail", "product_id", "ods_p_product", "product_id"),
            ]
        ),
    ),
    "run_metrics": _metrics("select * from m"),
    "metric_lookup": _metrics(
        "select * from m where metric = 'data_warehouse_sync_rows' "
        "and business in ('sqoop_ods_full_sync_o_order', 'sqoop_ods_full_sync_o_order_detail')"
    ),
    "metric_upsert": _metrics(
        f"select metric, business, case when date >= '{EXPORT_SINCE}' then value else -1 end as value, date from m"
    ),
    "metric_lines": _metrics(
        """select metric || '{business="' || business || '",date="' || date || '"} ' || value as line from m"""
    ),
    "export_order_trend": _trend("dws_order_stats_di"),
    "export_user_trend": _trend("dws_user_stats_di"),
    "export_product_trend": _trend("dws_product_stats_di"),
    "export_user_order_trend": _trend("dws_user_order_basic_di"),
    "export_lines": _LINES,
    # Every exported file is listed, one without lines as 0.
    "export_row_summary": f"select t.table_name, count(l.line) as row_count from ({_EXPORTED}) t "
    f"left join ({_LINES}) l using (table_name) group by t.table_name",
    "layered_run": with_views(
        _ALL_ODS,
        [("daily", _DAILY)],
        f"select metric, business, cast(value as bigint) as value, '{RUN_DT}' as date from ({_RUN_ROWS} "
        "union all select 'data_warehouse_full_flow_success', 'full_data_governance_flow', 1 "
        "union all select 'data_warehouse_sync_rows', 'sqoop_ods_full_sync_' || table_name, sum(n) from daily "
        "group by table_name "
        "union all select 'data_warehouse_sync_total_rows', 'sqoop_ods_full_sync', sum(n) from daily "
        "union all select 'data_warehouse_success_rate', 'sqoop_ods_full_sync', 1)",
    ),
    "layered_run_orders": with_views(
        ["ods_o_order"],
        [("dwd", _LAYERED_DWD), ("stats", _order_stats(f"select '{RUN_DT}' as dt"))],
        "select * replace (cast(total_order_count as int) as total_order_count, "
        "cast(valid_order_count as int) as valid_order_count) from stats",
    ),
    "layered_run_days": with_views(
        ["ods_o_order"],
        [("raw", _DAYS_RAW), ("dwd", DWD_ORDER.replace("from ods_o_order", "from raw")), ("stats", _order_stats("select distinct dt from dwd"))],
        "select * replace (cast(total_order_count as int) as total_order_count, "
        "cast(valid_order_count as int) as valid_order_count) from stats",
    ),
    "stream_cdc_tables": _table_rows(),
    "compacted_replay": _table_rows(),
    "validate_day": with_views(
        ["ods_u_user", "ods_p_product", "ods_o_order", "ods_o_order_detail"],
        [("dwd_u", DWD_USER), ("dwd_p", DWD_PRODUCT), ("dwd_o", DWD_ORDER), ("dwd_d", "select detail_id, order_id, product_id, quantity, create_time, dt from ods_o_order_detail"),
         ("rolled", "select order_id, sum(cast(round(price * quantity, 2) as decimal(16,2))) as order_amount from dwd_d join (select product_id, max_by(price, dt) as price from dwd_p group by product_id) using (product_id) group by order_id"),
         ("booked", "select order_id, sum(total_amount) as total_amount from dwd_o group by order_id")],
        _VALIDATE,
    ),
    "incremental_marks": with_views(
        ["ods_o_order"],
        [],
        "select order_id, user_id, total_amount, order_status, create_time, update_time, "
        f"cast(null as varchar) as op_type, cast(null as varchar) as op_ts, '{RUN_DT}' as dt "
        f"from ods_o_order where update_time < '{WINDOW[1]}'",
    ),
    "mixed_routes": with_views(
        ["ods_u_user_rows"],
        [],
        f"select 'full' as load_kind, '{RUN_DT}' as dt, count(*) as row_count from ods_u_user_rows "
        f"union all select 'window', '{RUN_DT}', count(*) from ods_u_user_rows where update_time < '{WINDOW[1]}' "
        f"union all select 'change', dt, count(*) from ({_ALL_ROWS}) where user_id is not null group by dt",
    ),
    "bad_change_events": (
        "select case event_id % 11 when 2 then 'payload' when 3 then 'day' else 'unroutable' end as reason, "
        "count(*) as row_count from events where event_id % 11 between 1 and 4 group by 1"
    ),
    "export_order_positions": with_views(
        ["ods_o_order"],
        [("dwd", DWD_ORDER)],
        f"select row_number() over (order by dt) - 1 as position, dt from (select distinct dt from dwd where dt >= '{EXPORT_SINCE}')",
    ),
    "minute_order_stats": (
        "select strftime(w, '%Y-%m-%d %H:%M:%S') as window_start, "
        "strftime(w + interval 1 minute, '%Y-%m-%d %H:%M:%S') as window_end, "
        "count(*) as order_count, cast(sum(cast(value as decimal(10,2))) as decimal(16,2)) as order_amount "
        "from (select *, date_trunc('minute', ts) as w from events) "
        "where w + interval 1 minute <= (select max(ts) - interval 5 second from events) "
        "group by w"
    ),
    "minute_orders_late": (
        "select strftime(w, '%Y-%m-%d %H:%M:%S') as window_start, "
        "strftime(w + interval 1 minute, '%Y-%m-%d %H:%M:%S') as window_end, "
        "count(*) as order_count, cast(sum(cast(value as decimal(10,2))) as decimal(16,2)) as order_amount "
        "from (select *, date_trunc('minute', ts) as w from events) "
        "where w + interval 1 minute <= (select max(ts) - interval 5 second from events) "
        "group by w"
    ),
    "stream_changelog_append": _FLATTEN,
    "replay_day_result": (
        f"select user_id, username, register_time, {_TAIL} from ("
        "select *, row_number() over (partition by dt, user_id order by op_ts desc, seq desc, pos desc) as rn "
        f"from ({_ALL_ROWS}) where user_id is not null and op_type <> 'DELETE' and dt = '{RUN_DT}') where rn = 1"
    ),
    "stream_cdc_merge": (
        f"select user_id, username, register_time, {_TAIL} from ("
        "select *, row_number() over (partition by dt, user_id order by op_ts desc, seq desc, pos desc) as rn "
        f"from ({_ALL_ROWS}) where user_id is not null and op_type <> 'DELETE') where rn = 1"
    ),
}
