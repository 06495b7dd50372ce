"""Calendar attributes of a date or zone-less timestamp, as Spark columns."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day and month names are blank-padded to the longest English name.
NAME_WIDTH = 9


def moment(value: datetime.datetime) -> Column:
    """A zone-less literal.  It goes through text: a literal made of a Python
    datetime is an instant and would shift with the session time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def date_key(day: Column) -> Column:
    """The day as the integer yyyymmdd; NULL stays NULL.

    Integer arithmetic rather than format-and-parse: the fact evaluates this
    for each of its rows, and it does not depend on the session time zone.
    """
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def iso_day_of_week(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def day_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "EEEE"), NAME_WIDTH, " ")


def month_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "MMMM"), NAME_WIDTH, " ")


def is_weekend(day: Column) -> Column:
    return iso_day_of_week(day).isin(6, 7)
