"""Incremental ingestion with Structured Streaming.

T1 ``stream_bronze``: landed CSV batches -> bronze parquet. The file source
remembers which files it has processed (checkpoint), so every run picks up
only new batches; ``Trigger.AvailableNow`` processes the backlog and stops,
which fits a daily scheduler.

T2 ``stream_silver``: bronze rows -> the table's change log, again through the file sink,
so every row is there once whatever is replayed or restarted. ``read_current`` is the
newest row per key over it, and ``compact`` a plain batch job that writes this state into
a folder of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import latest_by_key
from ..schemas import CSV_OPTIONS, RAW_SCHEMAS, SPECS, bronze_schema
from ..session import path_exists
from ..sinks.writers import write_full


def stream_bronze(spark: SparkSession, raw_root: str, bronze_root: str, table: str,
                  checkpoint: str, source_system: str = "postgres") -> StreamingQuery:
    """Start the raw->bronze stream for one table (AvailableNow trigger)."""
    schema = T.StructType(RAW_SCHEMAS[table].fields + [T.StructField("batch_date", T.DateType())])
    raw = (spark.readStream.schema(schema).options(**CSV_OPTIONS)
           .option("enforceSchema", False)  # a header other than the schema's names raises
           .option("maxFilesPerTrigger", 1000)
           .csv(f"{raw_root.rstrip('/')}/{table}"))
    bronze = raw.withColumns({
        "ingestion_timestamp": F.current_timestamp().cast("timestamp_ntz"),
        "source_system": F.lit(source_system),
        "source_file": F.col("_metadata.file_path"),
    }).select(*bronze_schema(table).fieldNames())
    return (bronze.writeStream.format("parquet").partitionBy("batch_date")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(f"{bronze_root.rstrip('/')}/{table}"))


def stream_silver(spark: SparkSession, bronze_root: str, silver_root: str, table: str,
                  checkpoint: str) -> StreamingQuery:
    """Start the stream of bronze rows into the table's change log (AvailableNow trigger).

    One checkpoint belongs to one log: a log's folder also keeps which files are complete,
    and readers follow that. Another checkpoint needs another ``silver_root``.
    """
    src = (spark.readStream.schema(bronze_schema(table))
           .parquet(f"{bronze_root.rstrip('/')}/{table}"))
    return (src.writeStream.format("parquet").partitionBy("batch_date")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(f"{silver_root.rstrip('/')}/{table}"))


def read_current(spark: SparkSession, silver_root: str, table: str, base: str | None = None) -> DataFrame | None:
    """The newest row per key of a streamed table (None before its first row).

    With ``base`` (what ``compact`` wrote last) only the log's batches from the newest one
    of the base on are read, which prunes the log by its partitions.
    """
    path = f"{silver_root.rstrip('/')}/{table}"
    if not path_exists(spark, path):
        return None
    spec = SPECS[table]
    rows = spark.read.schema(bronze_schema(table)).parquet(path)
    if base is not None:
        held = spark.read.schema(bronze_schema(table)).parquet(base)
        rows = rows.where(F.col("batch_date") >= held.select(F.max("batch_date")).scalar()).unionByName(held)
    return latest_by_key(rows, spec.key, list(spec.order_by), list(spec.tie_breakers))


def compact(spark: SparkSession, silver_root: str, table: str, out: str, base: str | None = None) -> None:
    """Write the current state of a streamed table to the new folder ``out``."""
    write_full(read_current(spark, silver_root, table, base), out)
