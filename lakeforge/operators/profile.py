"""Distribution profiles: concentration shares and bucketed counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def magnitude_block(col: Column) -> Column:
    """Monotone block number of a non-negative long: its length in bits and the seven bits
    after the first. Below 128 every value has a block of its own; there are some 7,400."""
    spare = F.greatest(F.length(F.bin(col)) - 8, F.lit(0))
    return (spare * 128 + F.call_function("shiftright", col, spare)).cast("int")


def running_before(hist: DataFrame, value: str, amounts: Sequence[str]) -> DataFrame:
    """``hist`` with, for each of ``amounts``, ``<name>_before``: its sum over the rows with a
    smaller ``value`` (a non-negative long; unique), and ``<name>_all``: its sum over all.

    Rows are never ordered in one task. Values fall into blocks of like magnitude, whose
    number is bounded whatever the data; the blocks' sums get the running sum, and inside a
    block a window of its own does.
    """
    placed = hist.withColumn("__block", magnitude_block(F.col(value)))
    blocks = placed.groupBy(F.col("__block").alias("__b")).agg(*[F.sum(a).alias(f"__{a}") for a in amounts])
    # one row per block: a bounded number of rows in one task, and a bounded broadcast
    below = Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    blocks = blocks.select("__b", *[F.coalesce(F.sum(f"__{a}").over(below), F.lit(0)).alias(f"__{a}_below")
                                    for a in amounts],
                           *[F.sum(f"__{a}").over(every).alias(f"{a}_all") for a in amounts])
    inside = Window.partitionBy("__block").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(F.broadcast(blocks), F.col("__block") == F.col("__b"))
    for a in amounts:
        joined = joined.withColumn(f"{a}_before", F.col(f"__{a}_below") + F.coalesce(F.sum(a).over(inside), F.lit(0)))
    return joined.drop("__block", "__b", *[f"__{a}_below" for a in amounts])


def concentration(counts: DataFrame, count_col: str,
                  segments: Sequence[tuple[str, int, bool]]) -> DataFrame:
    """Share of the total held by the top (or bottom) fraction of entities.

    ``counts`` has one row per entity (e.g. product) with its ``count_col`` (0 or more;
    zero-count entities included). ``segments`` are ``(name, percent, top)``;
    a segment covers ``ceil(percent * entities / 100)`` entities (integer arithmetic) taken from the top
    (largest counts) or the bottom.

    Exact without sorting the entities: entities with equal counts are interchangeable, so
    the work runs on the histogram of counts (one row per distinct count value). Its running
    sums (``running_before``) tell how many entities of each bin fall inside each segment;
    all segments are summed in one pass. Output: segment, entities, covered, lines, share.
    """
    hist = counts.groupBy(F.col(count_col).cast("long").alias("c")).agg(F.count(F.lit(1)).alias("n"))
    hist = running_before(hist.withColumn("held", F.col("c") * F.col("n")), "c", ["n", "held"])
    sums = [F.max("n_all").alias("entities"), F.max("held_all").alias("total")]
    parts = []
    for i, (name, percent, top) in enumerate(segments):
        want = F.expr(f"(n_all * {int(percent)} + 99) div 100")
        ahead = (F.col("n_all") - F.col("n_before") - F.col("n")) if top else F.col("n_before")
        take = F.greatest(F.lit(0), F.least(F.col("n"), want - ahead))
        sums += [F.max(want).cast("bigint").alias(f"covered{i}"), F.sum(take * F.col("c")).cast("bigint").alias(f"lines{i}")]
        parts.append(F.struct(F.lit(name).alias("segment"), F.col("entities"), F.col(f"covered{i}").alias("covered"),
                              F.col(f"lines{i}").alias("lines"),
                              (F.col(f"lines{i}").cast("double") / F.col("total").cast("double")).alias("share")))
    return hist.agg(*sums).select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def bucketize(col: Column, bounds: Sequence[tuple[str, int | None]]) -> Column:
    """Label by upper bound: ``[("dormant", 0), ("light", 2), ..., ("vip", None)]``."""
    expr = None
    for label, upper in bounds:
        cond = F.lit(True) if upper is None else col <= F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr
