"""High-water-mark state: one row per pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, list_names, path_exists

STATE_SCHEMA = "pipeline_name string, last_watermark timestamp_ntz, updated_at timestamp_ntz"


def get_watermark(state: DataFrame, pipeline: str) -> DataFrame:
    """The state row of ``pipeline`` (zero rows: never run, i.e. full load)."""
    return state.where(F.col("pipeline_name") == F.lit(pipeline)).select(
        "pipeline_name", "last_watermark")


def advance_watermark(state: DataFrame, batch: DataFrame, pipeline: str, ts_col: str,
                      updated_at=None) -> DataFrame:
    """New state table after publishing ``batch``.

    The pipeline's watermark becomes ``max(ts_col)`` of the batch, only when
    the batch is non-empty (an empty batch keeps the old value) and never goes back (a
    batch of late rows, or a rerun, may hold older ones only); other
    pipelines are untouched. Call it after the batch is published, so a
    failed landing is re-read next time. ``max`` is a partial aggregate: one
    value per task crosses the shuffle.
    """
    ts = F.current_timestamp().cast("timestamp_ntz") if updated_at is None else \
        F.lit(updated_at).cast("timestamp_ntz")
    newest = batch.agg(F.max(ts_col).cast("timestamp_ntz").alias("__new"))
    mine = state.where(F.col("pipeline_name") == F.lit(pipeline))
    # full outer join on the pipeline name: covers a first run (no state row)
    cand = newest.select(F.lit(pipeline).alias("pipeline_name"), "__new")
    merged = cand.join(mine, "pipeline_name", "full_outer").select(
        "pipeline_name",
        F.greatest("__new", "last_watermark").alias("last_watermark"),
        F.when(F.col("__new").isNotNull(), ts).otherwise(F.col("updated_at")).alias("updated_at"))
    others = state.where(F.col("pipeline_name") != F.lit(pipeline))
    return others.unionByName(merged)


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removeprefix("version=")) for n in list_names(spark, path)
                  if n.startswith("version=") and path_exists(spark, f"{path}/{n}/_SUCCESS"))


def write_state(state: DataFrame, path: str) -> None:
    """Persist the state table (one row per pipeline) as a new version.

    The version before stays until the new one is complete, so a crash in between loses
    nothing; older ones are removed.
    """
    spark = state.sparkSession
    old = _versions(spark, path)
    new = old[-1] + 1 if old else 0
    state.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={new}")
    for n in old[:-1]:
        delete_path(spark, f"{path}/version={n}")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version; no rows where none was ever written."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(f"{path}/version={versions[-1]}")
