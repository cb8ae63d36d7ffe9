"""Time arithmetic and calendar features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS = {"seconds": 1e6, "minutes": 6e7, "hours": 3.6e9, "days": 8.64e10}


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; accepts timestamps with and without time zone."""
    return F.unix_micros(ts.cast("timestamp"))


def elapsed(start: Column, end: Column, unit: str) -> Column:
    """Fractional time from ``start`` to ``end`` in seconds, minutes, hours or days."""
    return (micros(end) - micros(start)) / F.lit(_MICROS[unit])


def day_of_week(ts: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(ts) - 1


def hour(ts: Column) -> Column:
    return F.hour(ts)


def date_parts(day: Column) -> dict[str, Column]:
    """Calendar attributes of a date, in the order of the calendar dimension."""
    month = F.month(day)
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": month,
        "week_of_year": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": day_of_week(day),
        "day_of_year": F.dayofyear(day),
        "year_month": F.date_format(day, "yyyy-MM"),
        "year_quarter": F.concat(F.date_format(day, "yyyy"), F.lit("-Q"),
                                 F.quarter(day).cast("string")),
        "month_name": F.date_format(day, "MMMM"),
        "month_name_short": F.date_format(day, "MMM"),
        "day_name": F.date_format(day, "EEEE"),
        "day_name_short": F.date_format(day, "EEE"),
        "is_weekend": day_of_week(day).isin(0, 6),
        "is_weekday": ~day_of_week(day).isin(0, 6),
        **fiscal(day),
    }


def fiscal(day: Column, first_month: int = 4) -> dict[str, Column]:
    """Fiscal year and month for a year that opens in ``first_month``."""
    shifted = F.month(day) - first_month
    return {
        "fiscal_year": F.year(day) + F.when(shifted < 0, -1).otherwise(0),
        "fiscal_month": F.pmod(shifted, F.lit(12)) + 1,
    }
