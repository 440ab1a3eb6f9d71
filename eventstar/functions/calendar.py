"""Calendar attributes of the time dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: month and day names are blank-padded to nine characters, as a
# database's ``to_char(ts, 'Month')`` / ``to_char(ts, 'Day')`` render them.
NAME_WIDTH = 9


def time_key(d: Column) -> Column:
    """``yyyymmdd`` as INT: stable, and needs no lookup to assign."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_attributes(d: Column) -> list[Column]:
    """The dimension's columns for a DATE column ``d``.

    Day of week counts Sunday as 0; week of year is the ISO week.
    """
    dow = F.dayofweek(d)  # Sunday = 1 ... Saturday = 7
    return [
        time_key(d).alias("time_key"),
        d.alias("date_actual"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.rpad(F.date_format(d, "MMMM"), NAME_WIDTH, " ").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        (dow - 1).alias("day_of_week"),
        F.rpad(F.date_format(d, "EEEE"), NAME_WIDTH, " ").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        dow.isin(1, 7).alias("is_weekend"),
    ]
