"""Latest-row-per-key (deduplication) and SCD1 upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__lf_rn"
LOAD_FROM, LOAD_TO = "__load_from", "__load_to"


def _ordering(order_by: Sequence[str | Column], ascending: bool) -> list[Column]:
    out = []
    for c in order_by:
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.asc_nulls_last() if ascending else col.desc_nulls_last())
    return out


def latest_by_key(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str | Column],
                  tie_breakers: Sequence[str | Column] = (), ascending: bool = False) -> DataFrame:
    """Keep one row per ``keys``: the newest by ``order_by`` then ``tie_breakers``.

    Written as ``row_number() over (partition by keys order by ...) = 1`` so that
    Catalyst plans a partial ``WindowGroupLimit`` before the shuffle: every map
    task forwards at most one row per key, which also defuses a hot key (one key
    holding a large share of the rows is reduced map-side, not in one reducer).
    Rows whose ordering ties are resolved by ``tie_breakers``; pass a unique set
    to make the choice deterministic.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*_ordering(list(order_by) + list(tie_breakers), ascending))
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def latest_by_load(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str | Column],
                   tie_breakers: Sequence[str | Column], batch_col: str, loads: Sequence[str],
                   hot_keys: bool = False) -> DataFrame:
    """The newest row per key as of every load date, in one pass whatever their number.

    The result of ``latest_by_key`` over the batches up to a load is the rows whose
    ``LOAD_FROM`` .. ``LOAD_TO`` (both inclusive, dates of ``loads``) hold that load
    (``at_loads`` spreads them out). A row enters at the first load on or after its batch;
    of the rows of a key that enter together only the newest counts, and it replaces the one
    before only if it isn't older than everything that entered earlier. A batch after the last
    load, or without a date, is in none.

    All windows are over the key alone, so the rows are shuffled once and stay dealt out by
    key for whoever picks one of its versions next. A key's rows then meet in one task, which
    spills what it can't hold. With ``hot_keys`` each map task first keeps a key's newest row
    per load (a second shuffle), for sources where a key holds a large share of the rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    dates = load_dates(loads)
    order = list(order_by) + list(tie_breakers)
    entered = df.withColumn(LOAD_FROM, _first_load(F.col(batch_col), loads)).where(F.col(LOAD_FROM).isNotNull())
    if hot_keys:
        entered = latest_by_key(entered, [*keys, LOAD_FROM], order_by, tie_breakers)
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    # the newest row of a load comes first in it, after all rows of earlier loads
    by_load = Window.partitionBy(*keys).orderBy(LOAD_FROM, *_ordering(order, False))
    ranked = entered.withColumns({"__last": F.lag(LOAD_FROM).over(by_load),
                                  "__before": F.max(rank).over(by_load.rowsBetween(Window.unboundedPreceding, -1))})
    ahead = ranked.where((F.col("__last").isNull() | (F.col("__last") != F.col(LOAD_FROM)))
                         & (F.col("__before").isNull() | (rank >= F.col("__before"))))
    until = F.lead(LOAD_FROM).over(Window.partitionBy(*keys).orderBy(LOAD_FROM))
    return (ahead.withColumn("__until", until)
            .withColumn(LOAD_TO, F.when(F.col("__until").isNull(), F.lit(max(loads)).cast("date"))
                        .otherwise(F.array_max(F.filter(dates, lambda d: d < F.col("__until")))))
            .drop("__last", "__before", "__until"))


def _first_load(batch: Column, loads: Sequence[str]) -> Column:
    """The first load on or after a batch's date (null: none). Few loads are a chain of
    comparisons, which is compiled; many are a search in their array."""
    if len(loads) > 32:
        return F.array_min(F.filter(load_dates(loads), lambda d: d >= batch))
    out = None
    for d in sorted(loads):
        day = F.lit(d).cast("date")
        out = F.when(batch <= day, day) if out is None else out.when(batch <= day, day)
    return out


def load_dates(loads: Sequence[str]) -> Column:
    return F.array(*[F.lit(d).cast("date") for d in loads])


def at_loads(versions: DataFrame, loads: Sequence[str], name: str = "load_date") -> DataFrame:
    """A row for each load that holds a version of ``latest_by_load``, with the load's date."""
    held = F.filter(load_dates(loads), lambda d: d.between(F.col(LOAD_FROM), F.col(LOAD_TO)))
    return versions.withColumn(name, F.explode(held)).drop(LOAD_FROM, LOAD_TO)


def apply_scd1(base: DataFrame, changes: DataFrame, keys: str | Sequence[str],
               updated_at: str, tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """SCD type 1: overwrite attributes in place by key, newest ``updated_at`` wins.

    ``changes`` may carry a subset of the columns; missing ones are taken as NULL
    and filled from the current row (``coalesce`` over the key group would need a
    second pass, so partial change rows keep base values via a left join).
    Plain parquet tables have no MERGE, so this is union + latest-by-key: one
    shuffle on the key, no driver work.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    missing = [c for c in base.columns if c not in changes.columns]
    if missing:
        # partial change rows: complete them from the base row of the same key
        changes = changes.join(base.select(*keys, *missing), on=keys, how="left")
    changes = changes.select(*base.columns)
    # base rows rank below change rows that carry the same timestamp
    src = "__lf_src"
    both = base.withColumn(src, F.lit(0)).unionByName(changes.withColumn(src, F.lit(1)))
    return latest_by_key(both, keys, [updated_at], [src, *tie_breakers]).drop(src)
