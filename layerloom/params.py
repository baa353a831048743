"""Run parameters: business dates and the meaning of the ``dt`` partition."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

DT_POLICIES = ("run_date", "business_date", "op_date")
_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def check_dt(dt: str) -> str:
    """Return ``dt`` when it is a real yyyy-MM-dd date, else raise ValueError."""
    if not isinstance(dt, str) or not _DAY.fullmatch(dt):
        raise ValueError(f"dt must be yyyy-MM-dd, got {dt!r}")
    date.fromisoformat(dt)
    return dt


def run_dt(dt: str | None = None, today: date | None = None) -> str:
    """The business date of a run: ``dt`` if given, else yesterday in UTC."""
    if dt is not None:
        return check_dt(dt)
    return ((today or datetime.now(timezone.utc).date()) - timedelta(days=1)).isoformat()


def now_text(lag_seconds: int = 0) -> str:
    """The time in UTC, as all times are read, or that many seconds before."""
    return (datetime.now(timezone.utc) - timedelta(seconds=lag_seconds)).strftime("%Y-%m-%d %H:%M:%S")


def check_policy(policy: str) -> str:
    if policy not in DT_POLICIES:
        raise ValueError(f"dt_policy must be one of {DT_POLICIES}, got {policy!r}")
    return policy
