"""Staging layer: typed projections of every load of the silver tables, appended by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.latest import LOAD_TO, at_loads
from ..schemas import SPECS, staging_schema
from ..sinks.writers import align_by_name
from .registry import Context, model
from .silver import SILVER_OUTPUTS


def staged(ctx: Context, table: str, source: str | None = None, each_load: bool = True) -> DataFrame:
    """All loads of a silver table, with the date of the load, in the declared column types.

    The loads come from ``staging_loader`` (written loads of earlier runs), or are the
    silver output as of each date of ``loads``; without either, this run's silver output is
    the only load. ``source`` names another model than the silver output to load. Bronze is
    read once, however many loads there are. Without ``each_load`` a version that several
    loads hold comes once, under the last of them: enough for whoever picks the newest.
    """
    target = staging_schema(table)
    loaded = ctx.opt("staging_loader")
    if loaded:
        return align_by_name(loaded(table), target)
    model_name = source or SILVER_OUTPUTS[table]
    dates = ctx.opt("loads")
    if not dates:
        return align_by_name(ctx.ref(model_name).withColumn("load_date", F.lit(None).cast("date")), target)
    versions = ctx.over_loads(dates).ref(model_name)
    if each_load:
        return align_by_name(at_loads(versions, dates), target)
    return align_by_name(versions.withColumn("load_date", F.col(LOAD_TO)), target)


def _register(table: str) -> None:
    def stg(ctx: Context) -> DataFrame:
        return staged(ctx, table)

    def versions(ctx: Context) -> DataFrame:
        return staged(ctx, table, each_load=False)

    stg.__doc__ = f"Staging projection of {table}."
    versions.__doc__ = f"Staged versions of {table}, each once."
    model(f"stg_{table}", "staging")(stg)
    model(f"versions_{table}", "staging")(versions)


for _t in SPECS:
    _register(_t)


@model("versions_order_heads", "staging")
def versions_order_heads(ctx: Context) -> DataFrame:
    """Staged versions of orders without the exchange rate: loaded before the FX join."""
    return staged(ctx, "orders", "orders_mandatory", each_load=False).drop("exchange_rate")
