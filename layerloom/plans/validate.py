"""All row checks of one day as one frame of findings, from one pass over each table.

Every row gives a fact about its own key and one, without a day, about each foreign key that it holds. Facts of all tables are
added up per key and day, then per key, where repeated keys, values without a parent and amounts that differ can be seen together;
missing and unaccepted values travel as counters of the same rows. Both steps combine before their shuffle, so a hot key leaves
each task as one row. Products are read once more for the prices of the order details.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.numbers import cents
from layerloom.operators import quality, rollup
from layerloom.schemas import SOURCE_TABLES

COLUMNS = ("check_name", "table_name", "detail", "findings")


@dataclass(frozen=True)
class Check:
    """A row of the result, and the counter that feeds it among those of a table's keys."""

    name: str
    table: str
    detail: str
    keys_of: str
    counter: str = ""


def _rules(table: str) -> dict[str, Column]:
    if table == "p_product":
        return {"price_below_zero": quality.price_below_zero()}
    return {"status_out_of_domain": quality.status_out_of_domain()} if table == "o_order" else {}


def _checks(details: Mapping[str, DataFrame]) -> tuple[list[Check], dict[str, dict[str, Column]]]:
    """The checks of the given tables, and the row counters of each table by name."""
    checks: list[Check] = []
    counters: dict[str, dict[str, Column]] = {}
    children = dict.fromkeys(details, 0)
    for name, df in details.items():
        spec = SOURCE_TABLES[name]
        checks.append(Check("repeated_key", name, spec.key, name))
        rules = {("domain", rule): condition for rule, condition in _rules(name).items()}
        rules |= {("missing_value", c): F.col(c).isNull() for c in spec.not_null if c in df.columns}
        counters[name] = {}
        for i, ((check, detail), condition) in enumerate(rules.items()):
            counters[name][f"row_{i}"] = condition
            checks.append(Check(check, name, detail, name, f"row_{i}"))
        for column, parent in spec.foreign_keys:
            if parent in details:
                checks.append(Check("orphan", name, column, parent, f"child_{children[parent]}"))
                children[parent] += 1
    if {"o_order", "o_order_detail", "p_product"} <= details.keys():
        checks.append(Check("amount", "o_order", "total_amount", "o_order"))
    return checks, counters


def _facts(name: str, details: Mapping[str, DataFrame], checks: list[Check], counters: Mapping[str, Column]) -> DataFrame:
    """``keys_of, key, dt, own`` and counters: what the rows of a table say about their own key and their foreign keys."""
    df, spec, amounts = details[name], SOURCE_TABLES[name], any(c.name == "amount" for c in checks)
    one, names = F.lit(1).cast("bigint"), sorted({c.counter for c in checks if c.counter})
    none = F.lit(None).cast("bigint")
    if amounts and name == "o_order_detail":
        prices = rollup.latest_prices(details["p_product"]).withColumnRenamed("product_id", "priced")
        df = df.join(prices, df["product_id"] == prices["priced"], "left")

    def fact(keys_of: str, key: str, dt: Column, own: Column, found: Mapping[str, Column], booked: Column = none, rolled: Column = none) -> Column:
        values = [found.get(c, none).cast("bigint").alias(c) for c in names]
        return F.struct(
            F.lit(keys_of).alias("keys_of"), F.col(key).cast("bigint").alias("key"), dt.alias("dt"), own.alias("own"),
            booked.cast("bigint").alias("booked"), rolled.cast("bigint").alias("rolled"), *values,
        )

    booked = cents("total_amount") if amounts and name == "o_order" else none
    facts = [fact(name, spec.key, F.col("dt"), one, {c: condition.cast("bigint") for c, condition in counters.items()}, booked)]
    for check in checks:
        if check.name == "orphan" and check.table == name:
            amount = F.round(F.col("price") * F.col("quantity"), 2).cast("decimal(16,2)") if amounts and name == "o_order_detail" else None
            rolled = cents(amount) if amount is not None and check.keys_of == "o_order" else none
            # only rows of a key are counted by day; what others say about it meets in one row before the shuffle
            no_day = F.lit(None).cast("string")
            facts.append(fact(check.keys_of, check.detail, no_day, F.lit(0).cast("bigint"), {check.counter: one}, none, rolled))
    return df.select(F.inline(F.array(*facts)))


def _findings(details: Mapping[str, DataFrame]) -> DataFrame:
    """One row of the result for each check of the detail tables; a check without findings has 0."""
    checks, counters = _checks(details)
    facts = reduce(DataFrame.unionByName, [_facts(name, details, checks, counters[name]) for name in details])
    sums = [c for c in facts.columns if c not in ("keys_of", "key", "dt")]
    per_day = facts.groupBy("keys_of", "key", "dt").agg(*[F.sum(c).alias(c) for c in sums])
    repeated = F.count_if(F.col("own") > 1).alias("repeated")
    per_key = per_day.groupBy("keys_of", "key").agg(repeated, *[F.sum(c).alias(c) for c in sums])

    def findings(check: Check) -> Column:
        mine = F.col("keys_of") == check.keys_of
        if check.name == "repeated_key":
            return F.sum(F.when(mine, F.col("repeated")))
        if check.name == "orphan":
            return F.sum(F.when(mine & (F.col("own") == 0) & F.col("key").isNotNull(), F.col(check.counter)))
        if check.name == "amount":
            return F.count_if(mine & (F.coalesce("booked", F.lit(0)) != F.coalesce("rolled", F.lit(0))))
        return F.sum(F.when(mine, F.col(check.counter)))

    totals = per_key.agg(*[F.coalesce(findings(c), F.lit(0)).cast("bigint").alias(f"n{i}") for i, c in enumerate(checks)])
    named = [(F.lit(c.name), F.lit(c.table), F.lit(c.detail), F.col(f"n{i}")) for i, c in enumerate(checks)]
    rows = [F.struct(*[value.alias(column) for value, column in zip(row, COLUMNS, strict=True)]) for row in named]
    return totals.select(F.inline(F.array(*rows)))


def _change_types(name: str, df: DataFrame) -> DataFrame:
    census = quality.op_type_census(df, ())
    return census.select(
        F.lit("op_type").alias("check_name"), F.lit(name).alias("table_name"), F.col("op_type").cast("string").alias("detail"), F.col("row_count").alias("findings")
    )


def validate(raw: Mapping[str, DataFrame], details: Mapping[str, DataFrame]) -> DataFrame:
    """``check_name, table_name, detail, findings`` over raw and detail frames by source table.

    ``op_type`` counts change types of raw tables and is no fault; every other row with
    findings above 0 is one: repeated keys, values out of their domain, missing values,
    foreign keys without a parent, and orders whose booked amount is not that of their details.
    """
    found = [_change_types(name, df) for name, df in raw.items()]
    return reduce(DataFrame.unionByName, [*found, _findings(details)] if details else found)


def faults(findings: DataFrame) -> DataFrame:
    return findings.filter((F.col("check_name") != "op_type") & (F.col("findings") > 0))
