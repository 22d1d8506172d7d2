"""Dates, ISO weeks and integer date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """`YYYYMMDD` as an int; NULL stays NULL."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def key_date(key: Column) -> Column:
    """The inverse of `date_key`."""
    year = F.floor(key / F.lit(10000)).cast("int")
    month = F.pmod(F.floor(key / F.lit(100)), F.lit(100)).cast("int")
    return F.make_date(year, month, F.pmod(key, F.lit(100)).cast("int"))


def month_key(year: Column, month: Column) -> Column:
    """Date key of the first day of a month."""
    return (year * 10000 + month * 100 + 1).cast("int")


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def week_start(day: Column) -> Column:
    """The Monday on or before a day. `trunc` keeps it a date."""
    return F.trunc(day, "week")


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("yearofweek"), day).cast("int")


def iso_week(day: Column) -> Column:
    return F.weekofyear(day).cast("int")


def iso_week_monday(year: Column, week: Column) -> Column:
    """Monday of an ISO week. The 4th of January is always in week 1; a week 53 of a
    year with 52 weeks is the first one of the next year."""
    first = week_start(F.make_date(year, F.lit(1), F.lit(4)))
    return F.date_add(first, (week - 1) * 7)
