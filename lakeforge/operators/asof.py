"""As-of lookup on a date axis: for each left date, the newest right row at or before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_latest(left: DataFrame, left_date: str, right: DataFrame, right_date: str,
                right_cols: Sequence[str]) -> DataFrame:
    """Left rows extended with ``right_cols`` of the newest right row with
    ``right_date <= left_date`` (NULLs when there is none).

    No range join, and no step that sees a data-sized group:

    1. the left side is reduced to its distinct days (partial aggregate), so a
       day holding a large share of the rows costs one row from here on;
    2. days and right rows are unioned and a running ``last(ignorenulls)`` is
       taken inside year buckets (one window partition per year, at most one
       row per day plus the right rows of that year);
    3. days whose year holds no earlier right row take the carry-over of the
       preceding years, from a table with one row per year, joined by year;
    4. the per-day answers (calendar-sized) are joined back to the left rows.

    Right rows must be unique on ``right_date`` (one snapshot per day).
    """
    right_cols = list(right_cols)
    tag = "__lf_is_right"
    days = left.select(F.col(left_date).cast("date").alias("__d")).distinct()
    l = days.select(F.year("__d").alias("__y"), "__d", F.lit(0).alias(tag),
                    *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_cols])
    r = right.select(F.year(right_date).alias("__y"), F.col(right_date).cast("date").alias("__d"),
                     F.lit(1).alias(tag), *right_cols)
    u = l.unionByName(r)
    # right rows sort before left rows of the same day: "at or before" is inclusive
    w = (Window.partitionBy("__y").orderBy(F.col("__d"), F.col(tag).desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # carry the whole right row as one struct so all columns come from the same row
    rs = F.struct(*[F.col(c) for c in right_cols])
    u = u.withColumn("__r", F.last(F.when(F.col(tag) == 1, rs), ignorenulls=True).over(w))
    hits = u.where(F.col(tag) == 0).select("__y", "__d", "__r")

    # per-year carry-in: newest right row of all earlier years (one row per year)
    last_per_year = (right.groupBy(F.year(right_date).alias("__y"))
                     .agg(F.max_by(F.struct(*[F.col(c) for c in right_cols]), F.col(right_date))
                          .alias("__last")))
    years = days.select(F.year("__d").alias("__y")).unionByName(
        last_per_year.select("__y")).distinct()
    yw = Window.orderBy("__y").rowsBetween(Window.unboundedPreceding, -1)
    carry = (years.join(last_per_year, "__y", "left")
             .withColumn("__carry", F.last("__last", ignorenulls=True).over(yw))
             .select("__y", "__carry"))
    per_day = hits.join(carry, "__y", "left").select(
        "__d", *[F.coalesce(F.col("__r"), F.col("__carry")).getField(c).alias(c)
                 for c in right_cols])
    # per_day comes out of a shuffle, so AQE knows its exact size at run time and
    # broadcasts it back only when it is small; otherwise this is a shuffle join
    out = left.join(per_day, F.col(left_date).cast("date") == F.col("__d"), "left")
    return out.drop("__d")
