"""Timestamp helpers. All timestamps are ``timestamp_ntz``; nothing depends on the session zone."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value: _dt.datetime | _dt.date | str) -> Column:
    """A ``timestamp_ntz`` literal."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    elif not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def shift_years(ts: Column, years: int) -> Column:
    return ts + F.make_ym_interval(F.lit(years), F.lit(0))


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def plus_hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"), F.lit(0), F.lit(0))


def trunc_second(ts: Column) -> Column:
    """``date_trunc('second')`` kept in ``timestamp_ntz`` (date_trunc itself returns LTZ)."""
    return F.date_trunc("second", ts).cast("timestamp_ntz")


def time_of_day(ts: Column) -> Column:
    """``HH:mm:ss.SSSSSS`` text: a time-of-day value whose text order is its time order."""
    return F.date_format(ts, "HH:mm:ss.SSSSSS")


def calendar_parts(ts: Column) -> dict[str, Column]:
    """year / month / day / time / date of a timestamp, as the timestamp dimension stores them."""
    return {
        "year": F.year(ts).cast("smallint"),
        "month": F.month(ts).cast("smallint"),
        "day": F.dayofmonth(ts).cast("smallint"),
        "time": time_of_day(ts),
        "date": F.to_date(ts),
    }


def month_range(run_date: _dt.date, months_back: int = 1) -> tuple[_dt.datetime, _dt.datetime]:
    """Half-open ``[first day of the month `months_back` before run_date, next month)``."""
    y, m = run_date.year, run_date.month - months_back
    while m < 1:
        y, m = y - 1, m + 12
    start = _dt.datetime(y, m, 1)
    end = _dt.datetime(y + (m == 12), m % 12 + 1, 1)
    return start, end


def day_before(run_date: _dt.date | _dt.datetime) -> tuple[_dt.datetime, _dt.datetime]:
    """Half-open ``[run_date - 1 day 00:00, run_date 00:00)``."""
    d = _dt.datetime(run_date.year, run_date.month, run_date.day)
    return d - _dt.timedelta(days=1), d
