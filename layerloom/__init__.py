"""Layered warehouse operators expressed as PySpark DataFrame and streaming jobs."""

from layerloom.schemas import DWS_SPECS, SOURCE_TABLES, TableSpec
from layerloom.session import build_session

__all__ = ["DWS_SPECS", "SOURCE_TABLES", "TableSpec", "build_session"]
