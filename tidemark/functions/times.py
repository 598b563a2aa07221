"""Dates and times: months, ISO text, slices."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"
ISO_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$"
SLICE_SECONDS_PER_DAY = 86_400


def month_key(day: Column) -> Column:
    """``yyyyMM``."""
    return F.date_format(day, "yyyyMM")


def parse_month(text: Column) -> Column:
    """``YYYY-MM`` -> the first day of that month."""
    return F.to_date(text, "yyyy-MM")


def parse_iso(text: Column) -> Column:
    """ISO text to a time without zone; NULL when it does not fit."""
    return F.try_to_timestamp(text, F.lit(ISO_PATTERN)).cast("timestamp_ntz")


def iso_text(moment: Column) -> Column:
    return F.date_format(moment, ISO_PATTERN)


def is_iso(text: Column) -> Column:
    return text.rlike(ISO_SHAPE)


def ntz(moment: datetime | str) -> Column:
    """A literal time without zone."""
    text = moment.isoformat(sep=" ") if isinstance(moment, datetime) else moment.replace("T", " ")
    return F.lit(text).cast("timestamp_ntz")


def months_between(first: Column, last: Column) -> Column:
    """Every month's first day from ``first`` to ``last``, both included.

    Empty when ``first`` is after ``last``, where a bare ``sequence`` would fail.
    """
    return F.when(
        first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
    ).otherwise(F.array().cast("array<date>"))


def slice_number(cursor: str, start: Column, days: int) -> Column:
    """Number of the ``days``-long slice, counted from ``start``."""
    micros = F.timestamp_diff("MICROSECOND", start, F.col(cursor))
    return F.floor(micros / F.lit(days * SLICE_SECONDS_PER_DAY * 1_000_000)).cast("int")


def or_now(moment: Column) -> Column:
    """The given end, or the current time."""
    return F.coalesce(moment, F.current_timestamp().cast("timestamp_ntz"))
