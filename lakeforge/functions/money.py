"""Exact money arithmetic conventions.

Amounts stay decimal through row arithmetic and sums (exact, independent of the
order in which partitions are combined); only the final figure is turned into a
double. Averages are ``sum / count`` in double, the same in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROW_MONEY = "decimal(18,4)"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col: str | Column) -> Column:
    return _c(col).cast(ROW_MONEY)


def sum_money(col: str | Column) -> Column:
    """Exact decimal sum, reported as double."""
    return F.sum(money(col)).cast("double")


def avg_money(col: str | Column) -> Column:
    """Mean of a money column: exact sum / non-null count, in double."""
    return F.try_divide(F.sum(money(col)).cast("double"), F.count(_c(col)))


def sum_int(col: str | Column) -> Column:
    return F.sum(_c(col)).cast("bigint")
