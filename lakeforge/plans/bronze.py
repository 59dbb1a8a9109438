"""Bronze layer: landed batch + lineage columns, written per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_SCHEMAS
from ..sinks.writers import replace_partition
from ..sources.files import read_raw_csv

SOURCE_SYSTEM = "postgres"


def with_lineage(df: DataFrame, batch_date: str, source_system: str = SOURCE_SYSTEM,
                 source_file: str | None = None, ingestion_ts: str | None = None) -> DataFrame:
    """Stamp ``ingestion_timestamp, batch_date, source_system, source_file``.

    ``source_file`` defaults to the scanned file of each row
    (``_metadata.file_path``, available on file sources); ``ingestion_ts``
    defaults to the query start time, a single value for the whole batch.
    """
    ts = (F.current_timestamp() if ingestion_ts is None else F.lit(ingestion_ts)) \
        .cast("timestamp_ntz")
    src = F.col("_metadata.file_path") if source_file is None else F.lit(source_file)
    return df.withColumns({
        "ingestion_timestamp": ts,
        "batch_date": F.lit(batch_date).cast("date"),
        "source_system": F.lit(source_system),
        "source_file": src,
    })


def run_bronze(spark: SparkSession, raw_root: str, bronze_root: str, table: str,
               batch_date: str, ingestion_ts: str | None = None) -> DataFrame:
    """Raw CSV batch -> bronze parquet partition ``batch_date=<d>`` (idempotent).

    The raw schema is enforced on read (no inference pass); rows are counted
    by the write itself through an ``Observation``, not by a second scan.
    """
    from pyspark.sql import Observation

    raw = read_raw_csv(spark, raw_root, table, batch_date, RAW_SCHEMAS[table])
    df = with_lineage(raw, batch_date, ingestion_ts=ingestion_ts)
    obs = Observation(f"bronze_{table}")
    replace_partition(df.observe(obs, F.count(F.lit(1)).alias("rows")), f"{bronze_root.rstrip('/')}/{table}", batch_date)
    return spark.createDataFrame([(table, batch_date, obs.get["rows"])],
                                 "table_name string, batch_date string, rows bigint")
