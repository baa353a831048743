"""Declared table shapes of every layer.

Columns of the source tables, keys and foreign keys are data: operators read them
from here instead of repeating column lists.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The lineage label written to every detail row and the database name
# that change events of the source system carry.
DATA_SOURCE = "mysql_demo_oltp"
SOURCE_DATABASE = "demo_oltp"


@dataclass(frozen=True)
class TableSpec:
    """One business table and its shape in the raw and detail layers."""

    name: str
    key: str
    columns: tuple[tuple[str, str], ...]
    time_column: str
    detail_columns: tuple[str, ...]
    foreign_keys: tuple[tuple[str, str], ...] = ()
    detail_format: str = "parquet"

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def time_columns(self) -> list[str]:
        return [name for name in self.column_names if name.endswith("_time")]

    @property
    def not_null(self) -> list[str]:
        """Every source column is declared NOT NULL (keys implicitly)."""
        return self.column_names

    @property
    def ods_name(self) -> str:
        return f"ods_{self.name}"

    @property
    def dwd_name(self) -> str:
        return f"dwd_{self.name}"

    def source_schema(self) -> T.StructType:
        return _schema(self.columns)

    def ods_schema(self) -> T.StructType:
        return _schema(self.columns + (("op_type", "string"), ("op_ts", "string"), ("dt", "string")))

    def dwd_schema(self) -> T.StructType:
        types = dict(self.columns)
        detail = tuple((c, types[c]) for c in self.detail_columns)
        return _schema(detail + (("data_source", "string"), ("etl_time", "string"), ("dt", "string")))


def _schema(columns: tuple[tuple[str, str], ...]) -> T.StructType:
    return T.StructType([T.StructField(n, T.DataType.fromDDL(t)) for n, t in columns])


# Source table names, column names, order and types.
USER = TableSpec(
    name="u_user",
    key="user_id",
    columns=(
        ("user_id", "int"),
        ("username", "string"),
        ("register_time", "string"),
        ("update_time", "string"),
    ),
    time_column="register_time",
    detail_columns=("user_id", "username", "register_time"),
)

PRODUCT = TableSpec(
    name="p_product",
    key="product_id",
    columns=(
        ("product_id", "int"),
        ("product_name", "string"),
        ("price", "decimal(10,2)"),
        ("create_time", "string"),
        ("update_time", "string"),
    ),
    time_column="create_time",
    detail_columns=("product_id", "product_name", "price", "create_time"),
)

ORDER = TableSpec(
    name="o_order",
    key="order_id",
    columns=(
        ("order_id", "int"),
        ("user_id", "int"),
        ("total_amount", "decimal(10,2)"),
        ("order_status", "tinyint"),
        ("create_time", "string"),
        ("update_time", "string"),
    ),
    time_column="create_time",
    detail_columns=("order_id", "user_id", "total_amount", "order_status", "create_time"),
    foreign_keys=(("user_id", "u_user"),),
)

ORDER_DETAIL = TableSpec(
    name="o_order_detail",
    key="detail_id",
    columns=(
        ("detail_id", "int"),
        ("order_id", "int"),
        ("product_id", "int"),
        ("quantity", "int"),
        ("create_time", "string"),
        ("update_time", "string"),
    ),
    time_column="create_time",
    detail_columns=("detail_id", "order_id", "product_id", "quantity", "create_time"),
    foreign_keys=(("order_id", "o_order"), ("product_id", "p_product")),
    detail_format="orc",
)

SOURCE_TABLES: dict[str, TableSpec] = {t.name: t for t in (USER, PRODUCT, ORDER, ORDER_DETAIL)}

# Metric tables, their columns and declared sink types.
DWS_SPECS: dict[str, tuple[tuple[str, str], ...]] = {
    "dws_order_stats_di": (
        ("total_order_count", "int"),
        ("total_order_amount", "decimal(16,2)"),
        ("avg_order_amount", "decimal(16,2)"),
        ("valid_order_count", "int"),
        ("valid_order_rate", "decimal(5,4)"),
        ("night_order_rate", "decimal(5,4)"),
        ("per_user_amount", "decimal(16,2)"),
    ),
    "dws_user_stats_di": (
        ("new_user_count", "int"),
        ("total_user_count", "int"),
        ("workhour_register_rate", "decimal(5,4)"),
    ),
    "dws_product_stats_di": (
        ("total_product_count", "int"),
        ("avg_product_price", "decimal(10,2)"),
        ("high_price_rate", "decimal(5,4)"),
        ("new_product_count", "int"),
    ),
    "dws_user_order_basic_di": (
        ("order_user_count", "int"),
        ("order_user_rate", "decimal(5,4)"),
    ),
}


def dws_schema(table: str) -> T.StructType:
    return _schema(DWS_SPECS[table] + (("etl_time", "string"), ("dt", "string")))


# Fixed value: names of raw loads that imports write.
IMPORTED = "^(full$|since_)"
