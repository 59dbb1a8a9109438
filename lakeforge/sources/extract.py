"""Source-system extracts: full snapshots, high-water-mark increments, late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import latest_by_key
from ..operators.rows import row_hash


def read_snapshot(spark: SparkSession, table: str, *, jdbc_url: str | None = None,
                  properties: dict | None = None, partition_column: str | None = None,
                  lower_bound: int | None = None, upper_bound: int | None = None,
                  num_partitions: int = 64, path: str | None = None,
                  predicates: Sequence[str] | None = None) -> DataFrame:
    """Full snapshot of a source table.

    Over JDBC the read is split into ``num_partitions`` range queries on a
    numeric key, or into the given ``predicates`` (see ``key_ranges``: parallel
    connections, no single-node pull); a parquet export (``path``) is read as files, of
    which each predicate would be a filter. The extract's ORDER BY is not kept: a
    snapshot is a set, and ordering happens on the landing write if at all.
    """
    if path is not None:
        return spark.read.parquet(path)
    if predicates:
        return spark.read.jdbc(jdbc_url, table, predicates=list(predicates), properties=properties or {})
    reader = spark.read.format("jdbc").option("url", jdbc_url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions))
    return reader.load()


def read_incremental(df: DataFrame, ts_col: str, watermark) -> DataFrame:
    """Rows strictly newer than the watermark (``ts > wm``).

    ``watermark`` is a value or a one-row DataFrame with ``last_watermark`` (as
    ``watermark.get_watermark`` returns), whose one value is read here. It enters the
    plan as a literal, which is pushed into the JDBC query / parquet scan; a NULL or
    absent watermark means a full load.
    """
    watermark = _value(watermark)
    if watermark is None:
        return df
    return df.where(F.col(ts_col) > F.lit(watermark).cast(df.schema[ts_col].dataType))


def _value(watermark):
    return watermark.agg(F.max("last_watermark")).first()[0] if isinstance(watermark, DataFrame) else watermark


def read_with_lookback(df: DataFrame, key: str, ts_col: str, watermark, lookback: str, landed: DataFrame,
                       landed_order: Sequence[str]) -> DataFrame:
    """The increment past the watermark, and what of the ``lookback`` before it was missed.

    A strict watermark never sees a row that arrives late under an older timestamp, nor a
    change of a row already landed. So the rows of the overlap (``lookback``, an interval
    such as "3 days", before the watermark) are read again, and of these only those whose
    content differs from the newest version landed of their key (by ``landed_order``): a
    late row and a change arrive once each, and a change back to an older state arrives too.

    Both sides are cut to the overlap by a literal that reaches their scans. The landed side
    is brought down to key and hash before it shuffles, and the rows past the watermark take
    no part in the join. A row whose timestamp moved out of the overlap isn't seen.
    """
    watermark = _value(watermark)
    if watermark is None:
        return df
    kind = df.schema[ts_col].dataType
    mark = F.lit(watermark).cast(kind)
    since = (mark - F.expr(f"INTERVAL {lookback}")).cast(kind)
    cols = df.columns
    known = landed.where((F.col(ts_col) > since) & (F.col(ts_col) <= mark))
    known = latest_by_key(known, key, list(landed_order)).select(F.col(key).alias("__key"), row_hash(cols).alias("__row"))
    overlap = df.where((F.col(ts_col) > since) & (F.col(ts_col) <= mark))
    missed = overlap.join(known, F.col(key).eqNullSafe(F.col("__key")) & (row_hash(cols) == F.col("__row")), "left_anti")
    return df.where(F.col(ts_col) > mark).unionByName(missed)


def key_ranges(df: DataFrame, key: str, ranges: int, accuracy: int = 10_000) -> list[str]:
    """Disjoint SQL predicates over ``key`` that share out all rows about evenly.

    Bounds are approximate quantiles of the keys (one pass; a sketch per task), not equal
    steps between the smallest and the largest: a skewed key still gives ranges of like
    size. A key so frequent that several quantiles fall on it is one range of its own, and
    null keys go with the first. Use them as the ``predicates`` of a partitioned read.
    """
    share = [i / ranges for i in range(1, ranges)]
    bounds = df.agg(F.percentile_approx(key, share, accuracy)).first()[0] if ranges > 1 else []
    bounds = sorted(set(bounds or []))  # at most one bound less than ranges
    if not bounds:
        return [f"{key} IS NOT NULL OR {key} IS NULL"]
    lit = [_literal(b) for b in bounds]
    inner = [f"{key} > {a} AND {key} <= {b}" for a, b in zip(lit, lit[1:], strict=False)]
    return [f"{key} <= {lit[0]} OR {key} IS NULL", *inner, f"{key} > {lit[-1]}"]


def _literal(value) -> str:
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(value)
    kind = {"datetime": "TIMESTAMP ", "date": "DATE "}.get(type(value).__name__, "")
    return f"{kind}'{value}'" if kind or type(value).__name__ != "Decimal" else str(value)
