"""Keyed difference of two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import null_safe
from .rows import row_hash

ADDED, REMOVED, CHANGED, SAME = "added", "removed", "changed", "same"


def table_diff(before: DataFrame, after: DataFrame, keys: str | Sequence[str],
               columns: Sequence[str] | None = None, keep_same: bool = False) -> DataFrame:
    """Keys, ``change`` (added, removed, changed) and ``changed_columns`` of rows that differ.

    ``columns`` are compared (default: all of both but the keys); a null equals a null only.
    Keys are unique on either side; a null key is a key. Two rows are compared by a hash
    first, and column by column where the hashes differ. With ``keep_same`` equal rows are
    returned too. One full outer join on the keys: a hot key can't be, as keys are unique.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = [c for c in before.columns if c in after.columns and c not in keys] if columns is None else list(columns)

    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"__{p}_{k}") for k in keys], F.struct(*columns).alias(f"__{p}"),
                         row_hash(columns).alias(f"__{p}_hash"))
    b, a = side(before, "b"), side(after, "a")
    both = b.join(a, null_safe([f"__b_{k}" for k in keys], [f"__a_{k}" for k in keys]), "full_outer")
    differs = F.filter(F.array(*[F.when(~F.col(f"__b.{c}").eqNullSafe(F.col(f"__a.{c}")), F.lit(c)) for c in columns]),
                       lambda c: c.isNotNull())
    change = (F.when(F.col("__b_hash").isNull(), ADDED).when(F.col("__a_hash").isNull(), REMOVED)
              .when(F.col("__b_hash") != F.col("__a_hash"), CHANGED).otherwise(SAME))
    none = F.array().cast("array<string>")
    out = both.select(*[F.coalesce(f"__a_{k}", f"__b_{k}").alias(k) for k in keys], change.alias("change"),
                      F.when(change == CHANGED, differs).otherwise(none).alias("changed_columns"))
    return out if keep_same else out.where(F.col("change") != SAME)


def diff_counts(before: DataFrame, after: DataFrame, keys: str | Sequence[str],
                columns: Sequence[str]) -> DataFrame:
    """One row per compared column: column_name, compared (rows on both sides), added, removed
    and changed rows."""
    d = table_diff(before, after, keys, columns, keep_same=True)
    sums = d.agg(*[F.count(F.when(F.col("change") == c, 1)).alias(c) for c in (ADDED, REMOVED, CHANGED, SAME)],
                 *[F.count(F.when(F.array_contains("changed_columns", c), 1)).alias(f"c{i}")
                   for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column_name"), (F.col(CHANGED) + F.col(SAME)).alias("compared"),
                     F.col(ADDED), F.col(REMOVED), F.col(f"c{i}").alias("changed")) for i, c in enumerate(columns)]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
