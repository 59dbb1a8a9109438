"""Calendar attributes of the date dimension (warehouse-dialect conventions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_date_key(col: str | Column) -> Column:
    return _c(col).cast("date")


def day_of_week_sun0(col: str | Column) -> Column:
    """Day of week with Sunday = 0 .. Saturday = 6 (Spark's ``dayofweek`` is 1..7)."""
    return (F.dayofweek(_c(col)) - 1).cast("int")


def month_name3(col: str | Column) -> Column:
    """Three-letter month name, e.g. ``Jul``."""
    return F.monthname(_c(col))


def day_name3(col: str | Column) -> Column:
    """Three-letter day name, e.g. ``Sun``."""
    return F.dayname(_c(col))


def calendar_columns(ts: str | Column) -> list[Column]:
    """The nine columns of the date dimension, derived from one timestamp."""
    d = to_date_key(ts)
    return [
        d.alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_name3(d).alias("month_name"),
        F.dayofmonth(d).alias("day"),
        day_of_week_sun0(d).alias("day_of_week"),
        day_name3(d).alias("day_name"),
    ]
