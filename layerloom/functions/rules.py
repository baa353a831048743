"""Value rules of the detail layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted order states, and the mark of any other state.
VALID_STATUSES = (1, 2, 3)
INVALID_STATUS = -1

MONEY = "decimal(10,2)"


def non_negative(c: Column | str, null_to_zero: bool = False) -> Column:
    """Negative money becomes 0; NULL stays unless ``null_to_zero``."""
    c = F.col(c) if isinstance(c, str) else c
    bad = (c < 0) | c.isNull() if null_to_zero else c < 0
    return F.when(bad, F.lit(0).cast(MONEY)).otherwise(c.cast(MONEY))


def checked_status(c: Column | str) -> Column:
    """An order state outside the accepted set, or NULL, becomes the invalid mark."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(*VALID_STATUSES), c).otherwise(F.lit(INVALID_STATUS)).cast("tinyint")


def non_null_key(key: str) -> Column:
    return F.col(key).isNotNull()
