"""Time expressions.

Times are handled as TIMESTAMP_NTZ so that results do not depend on the session zone, and
with ``try_cast`` so that a bad value becomes NULL instead of failing the job under ANSI
mode. Casting is about twice as fast as the pattern formatters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch milliseconds of 0001-01-01 and 9999-12-31T23:59:59.999; others count as bad values.
_MIN_MS, _MAX_MS = -62_135_596_800_000, 253_402_300_799_999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c: Column | str) -> Column:
    """'yyyy-MM-dd HH:mm:ss[.fraction]' text as TIMESTAMP_NTZ; anything else is NULL."""
    c = _col(c)
    full = (F.length(c) >= 19) & (F.substring(c, 11, 1) == " ")
    return F.when(full, c.try_cast("timestamp_ntz"))


def time_text(t: Column | str) -> Column:
    """A timestamp as 'yyyy-MM-dd HH:mm:ss' text, fraction cut."""
    return F.substring(_col(t).cast("string"), 1, 19)


def normalise_time(c: Column | str) -> Column:
    """Parse and re-format a time text; unparseable text becomes NULL."""
    return time_text(parse_time(c))


def business_day(c: Column | str) -> Column:
    """The yyyy-MM-dd day of a time text."""
    return F.substring(parse_time(c).cast("string"), 1, 10)


def hour_of(c: Column | str) -> Column:
    return F.hour(parse_time(c))


def day_of(c: Column | str) -> Column:
    """The DATE of a time text."""
    return parse_time(c).cast("date")


def epoch_ms_time(ms: Column | str) -> Column:
    """Epoch milliseconds as a UTC TIMESTAMP_NTZ; out-of-range values are NULL."""
    ms = _col(ms)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.when(ms.between(_MIN_MS, _MAX_MS), F.timestamp_add("MILLISECOND", ms, epoch))


def epoch_ms_text(ms: Column | str) -> Column:
    return time_text(epoch_ms_time(ms))


def epoch_ms_day(ms: Column | str) -> Column:
    return F.substring(epoch_ms_time(ms).cast("string"), 1, 10)


def to_epoch_ms(t: Column | str) -> Column:
    """A TIMESTAMP_NTZ read as UTC, in epoch milliseconds."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, _col(t))


def on_day(c: Column | str, dt: str) -> Column:
    """``DATE(c) = dt`` on a time column, as a range so that it can be pushed to the source."""
    c = _col(c)
    start = F.lit(dt).cast("date")
    return (c >= start.cast("timestamp_ntz")) & (c < F.date_add(start, 1).cast("timestamp_ntz"))


def load_time(etl_time: str | None) -> Column:
    """The load time column: a given text, or the time the job starts."""
    if etl_time is not None:
        return F.lit(etl_time)
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
