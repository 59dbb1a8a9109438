"""Whole-row helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(cols: Sequence[str]) -> Column:
    """64-bit hash of a row's content; a null differs from every value and from its absence."""
    return F.xxhash64(*[x for c in cols for x in (F.col(c), F.col(c).isNull())])
