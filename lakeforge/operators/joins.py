"""Join helpers: null-safe key equality, orphan detection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of two lists of columns in which a null equals a null (still an equi-join)."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)])


def orphans(child: DataFrame, fk: str | Sequence[str], parent: DataFrame,
            pk: str | Sequence[str] | None = None) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row (``left_anti``).

    NULL keys are not orphans (they are a not-null test's business).
    """
    fk = [fk] if isinstance(fk, str) else list(fk)
    pk = fk if pk is None else ([pk] if isinstance(pk, str) else list(pk))
    parent_keys = parent.select(*[F.col(p).alias(f"__pk{i}") for i, p in enumerate(pk)])
    cond: Column | None = None
    for i, f in enumerate(fk):
        c = F.col(f) == F.col(f"__pk{i}")
        cond = c if cond is None else cond & c
    nonnull = child
    for f in fk:
        nonnull = nonnull.where(F.col(f).isNotNull())
    return nonnull.join(parent_keys, cond, "left_anti")
