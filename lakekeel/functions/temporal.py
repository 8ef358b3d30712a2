"""Date and time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

DAYS_PER_YEAR = 365.25


def reference_day(as_of: dt.date | str | None) -> Column:
    """The day 'today' stands for; the current date unless one is given."""
    return F.current_date() if as_of is None else F.to_date(F.lit(str(as_of)))


def whole_years(since: Column, until: Column) -> Column:
    """Elapsed years by mean year length (bigint); NULL when a date is missing."""
    return F.floor(F.datediff(until, since) / F.lit(DAYS_PER_YEAR))


def as_date(column: Column, dtype: T.DataType) -> Column:
    """Date from a date column or from epoch days."""
    if isinstance(dtype, T.IntegralType):
        return F.date_from_unix_date(column.try_cast("int"))
    return column.try_cast("date")


def as_instant(column: Column, dtype: T.DataType) -> Column:
    """Timestamp from epoch microseconds, from text holding either those or ISO time, or as is.

    Text that is neither becomes NULL, so that one bad value cannot stop a batch.
    """
    if isinstance(dtype, T.IntegralType):
        return F.timestamp_micros(column)
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.timestamp_micros(column.try_cast("bigint")), column.try_cast("timestamp"))
    return column.cast("timestamp")


def day_first_date(text: Column) -> Column:
    """``d/M/yyyy`` text, padded or not; impossible days become NULL."""
    return F.try_to_date(text, "d/M/yyyy")


def local_time(instant: Column, offset_seconds: Column) -> Column:
    return F.timestamp_add("SECOND", offset_seconds, instant)


def date_parts(name: str, suffix: str) -> list[Column]:
    """The date itself and its day, month and year as ``jour_/mois_/annee_<suffix>``."""
    return [
        F.col(name),
        F.dayofmonth(name).alias(f"jour_{suffix}"),
        F.month(name).alias(f"mois_{suffix}"),
        F.year(name).alias(f"annee_{suffix}"),
    ]
