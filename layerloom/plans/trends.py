"""The four exported series of the metric tables, for drawing elsewhere."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from layerloom.sinks.exports import EXPORT_COLUMNS, trend


def trend_series(frames: Mapping[str, DataFrame], since: str) -> dict[str, DataFrame]:
    return {table: trend(frames[table], table, since) for table in EXPORT_COLUMNS}
