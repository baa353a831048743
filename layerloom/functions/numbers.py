"""Exact money and ratio arithmetic.

Money is summed as whole cents in BIGINT: the aggregation buffer stays fixed-width, so
Spark keeps it in its hash aggregate. Ratios are rounded half-up on integers, which leaves
no second rounding between the quotient and the sink type.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(c: Column | str) -> Column:
    """A two-digit decimal as BIGINT cents."""
    c = F.col(c) if isinstance(c, str) else c
    return (c * F.lit(100)).cast("bigint")


def from_cents(c: Column, dtype: str = "decimal(16,2)") -> Column:
    return (c.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(dtype)


def _quotient(num: Column, den: Column) -> Column:
    """num / den rounded half away from zero; NULL when den is 0. Both are whole numbers."""
    num, den = num.cast("decimal(30,0)"), den.cast("decimal(20,0)")
    guarded = F.nullif(den, F.lit(0).cast("decimal(20,0)"))
    size = F.call_function("div", F.abs(num) * 2 + guarded, guarded * 2)
    return F.when(num < 0, -size).otherwise(size)


def half_up_ratio(num: Column, den: Column, scale: int, dtype: str, num_scale: int = 0) -> Column:
    """``num * 10**-num_scale / den`` to ``scale`` digits; 0 when ``den`` is 0."""
    scaled = _quotient(num.cast("decimal(24,0)") * (10 ** (scale - num_scale)), den)
    unit = F.lit(Decimal(1).scaleb(-scale))
    value = (scaled.cast("decimal(20,0)") * unit).cast(dtype)
    return F.when(den == 0, F.lit(0).cast(dtype)).otherwise(value)


def average_price(cents_sum: Column, n: Column) -> Column:
    """AVG of DECIMAL(10,2) as stored in DECIMAL(10,2).

    The average of a two-digit decimal has six digits and is rounded again by the sink.
    """
    six_digits = _quotient(cents_sum.cast("decimal(24,0)") * 10_000, n)
    two_digits = _quotient(six_digits, F.lit(10_000))
    return from_cents(two_digits, "decimal(10,2)")
