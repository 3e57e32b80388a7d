"""Column expressions shared by the layers. All of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(name: str) -> Column:
    return F.trim(F.col(name))


def clean_code(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def money(name: str) -> Column:
    """Two-digit decimal; a value that does not fit becomes null instead of failing the job."""
    return F.col(name).try_cast("decimal(18,2)")


def event_time(millis: str | Column = "cdc_timestamp_ms") -> Column:
    return F.timestamp_millis(millis)


def now_or(as_of) -> Column:
    """``current_timestamp()``, or a given instant where a run must be repeatable."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
