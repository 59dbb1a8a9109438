"""Exchange-rate feed: payload explode, typed rates, last-known-good snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.asof import asof_latest
from ..operators.latest import latest_by_key
from ..schemas import FX_PAYLOAD_SCHEMA

# --- fixed values: status words of the feed ------------------------------------
STATUS_SUCCESS = "SUCCESS"
STATUS_DEGRADED = "DEGRADED"
# --- end of fixed values -------------------------------------------------------

STATUS_UNAVAILABLE = "UNAVAILABLE"
# the leading day name ("Wed, ") is dropped before parsing
FX_TIME_FORMAT = "dd MMM yyyy HH:mm:ss Z"


def fx_rows(payloads: DataFrame, payload_col: str = "payload",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``rates`` entry: base_currency, target_currency, exchange_rate, last_updated.

    ``payload_col`` holds the feed's JSON text; parsing and ``explode`` run per
    row inside the scan stage, so payloads of any number of days stay distributed.
    """
    p = F.from_json(F.col(payload_col), FX_PAYLOAD_SCHEMA)
    return (payloads.select(*keep, p.alias("__p"))
            .select(*keep, F.col("__p.base_code").alias("base_currency"),
                    F.explode("__p.rates").alias("target_currency", "exchange_rate"),
                    F.col("__p.time_last_update_utc").alias("last_updated")))


def fx_rates_typed(raw: DataFrame) -> DataFrame:
    """Landed FX rows -> (target_currency, exchange_rate double), unique per currency.

    Rates that do not parse become NULL (``try_cast``), so an order in that
    currency keeps a NULL rate rather than failing the batch. Duplicate rows
    for a currency would fan out the order join, so the newest one is kept.
    """
    typed = raw.select(
        "target_currency",
        F.col("exchange_rate").try_cast("double").alias("exchange_rate"),
        F.try_to_timestamp(F.substring_index(F.col("last_updated"), ", ", -1), F.lit(FX_TIME_FORMAT)).alias("__ts"))
    return latest_by_key(typed, "target_currency", ["__ts"],
                         [F.col("exchange_rate")]).drop("__ts")


def latest_good_fx(batches: DataFrame, snapshots: DataFrame, batch_col: str = "batch_date",
                   snapshot_col: str = "snapshot_date", status_col: str = "status",
                   payload_col: str = "payload", strict: bool = False) -> DataFrame:
    """For each batch date, the newest SUCCESS snapshot taken on or before it.

    Output columns: batch_date, snapshot_date, fx_status, payload. ``fx_status`` is
    SUCCESS when the batch's own day succeeded, DEGRADED when an older snapshot
    is reused, UNAVAILABLE when none exists (``strict`` raises instead, as the
    feed's extractor does).
    """
    good = snapshots.where(F.col(status_col) == STATUS_SUCCESS).select(
        F.col(snapshot_col).alias("__sd"), F.col(payload_col).alias("__payload"))
    # two good snapshots of one day: the same one is picked whatever the order of rows
    good = latest_by_key(good, "__sd", ["__payload"])
    keys = batches.select(F.col(batch_col).alias("batch_date")).distinct()
    picked = asof_latest(keys, "batch_date", good, "__sd", ["__sd", "__payload"])
    out = picked.select(
        "batch_date",
        F.col("__sd").alias("snapshot_date"),
        F.when(F.col("__sd").isNull(), F.lit(STATUS_UNAVAILABLE))
         .when(F.col("__sd") == F.col("batch_date"), F.lit(STATUS_SUCCESS))
         .otherwise(F.lit(STATUS_DEGRADED)).alias("fx_status"),
        F.col("__payload").alias("payload"))
    if strict and not out.where(F.col("snapshot_date").isNull()).isEmpty():
        raise RuntimeError("exchange rates unavailable and no earlier successful snapshot exists")
    return out
