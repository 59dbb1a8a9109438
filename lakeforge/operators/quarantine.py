"""Row validation: mandatory columns, predicate split with a quarantine output."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any mandatory column."""
    return df.dropna(how="any", subset=list(cols))


class Split(NamedTuple):
    valid: DataFrame
    rejected: DataFrame
    unknown: DataFrame


def split_valid(df: DataFrame, predicate: Column, reason: str,
                reason_col: str = "reject_reason", null_as_reject: bool = False) -> Split:
    """Three-way split on a predicate.

    ``valid``: predicate is true. ``rejected``: predicate is false, tagged with
    ``reason``. ``unknown``: predicate is NULL (e.g. a NULL e-mail), which a
    plain ``filter(p)`` / ``filter(~p)`` pair silently loses; with
    ``null_as_reject`` those rows join the rejects instead.

    All three are filters over the same lineage; no extra shuffle.
    """
    valid = df.where(predicate)
    bad = (~predicate) | predicate.isNull() if null_as_reject else ~predicate
    rejected = df.where(bad).withColumn(reason_col, F.lit(reason))
    unknown = df.where(predicate.isNull())
    return Split(valid, rejected, unknown)
