"""Two-phase publishing of a daily batch into the raw zone.

A batch lands in a zone of its own, is checked there, and is moved into the raw zone as
one folder per table. The record of the batch is written last: a batch without a record
isn't published, whatever of it was moved, and is landed again from the same watermark.
A published batch keeps its record, with the interval of the source it covers, so running
it again reads nothing that came later.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, move_path, path_exists
from .writers import replace_partition

RECORD = ("batch_date date, low_watermark timestamp_ntz, high_watermark timestamp_ntz, has_orders boolean, "
          "fx_status string, ingestion_ts string")


@dataclass(frozen=True)
class Batch:
    """A published batch: it covers the incremental source's rows past ``low`` up to ``high``."""
    batch_date: str
    low: object
    high: object
    has_orders: bool
    fx_status: str
    ingestion_ts: str


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all published batches (one row per batch)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).parquet(path)


def published(spark: SparkSession, path: str, batch_date: str) -> Batch | None:
    """The record of a batch; None where it was never published as a whole."""
    found = records(spark, path).where(F.col("batch_date") == F.lit(batch_date).cast("date")).collect()  # one row
    if not found:
        return None
    r = found[0]
    return Batch(batch_date, r.low_watermark, r.high_watermark, r.has_orders, r.fx_status, r.ingestion_ts)


def watermark_before(spark: SparkSession, path: str, batch_date: str):
    """The high-water mark that batches before ``batch_date`` reached (None: there is none)."""
    earlier = records(spark, path).where(F.col("batch_date") < F.lit(batch_date).cast("date"))
    return earlier.agg(F.max("high_watermark")).first()[0]


def publish(spark: SparkSession, landing: str, raw: str, batch_date: str, mandatory: Iterable[str],
            optional: Iterable[str] = ()) -> list[str]:
    """Move the landed folders of a batch into the raw zone; returns the tables moved.

    Raises before anything is moved if a mandatory one is missing. An optional table that
    didn't land has no folder in the raw zone afterwards either.
    """
    def at(zone: str, table: str) -> str:
        return f"{zone.rstrip('/')}/{table}/batch_date={batch_date}"

    mandatory = list(mandatory)
    missing = [t for t in mandatory if not path_exists(spark, at(landing, t))]
    if missing:
        raise RuntimeError(f"not landed for {batch_date}: {missing}")
    moved = []
    for t in [*mandatory, *optional]:
        if path_exists(spark, at(landing, t)):
            move_path(spark, at(landing, t), at(raw, t))
            moved.append(t)
        else:
            delete_path(spark, at(raw, t))
    return moved


def record(spark: SparkSession, path: str, batch: Batch) -> None:
    """Write the record of a batch: the commit of its publication."""
    row = spark.createDataFrame([(None, batch.low, batch.high, batch.has_orders, batch.fx_status, batch.ingestion_ts)],
                                RECORD)
    replace_partition(row, path, batch.batch_date)
