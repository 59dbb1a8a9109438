"""File-zone readers: landed CSV batches, bronze/silver parquet, FX CSV."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CSV_OPTIONS, FX_RAW_SCHEMA, RAW_SCHEMAS, bronze_schema
from ..session import path_exists
from ..sinks.writers import align_by_name


def batch_path(root: str, table: str, batch_date: str) -> str:
    return f"{root.rstrip('/')}/{table}/batch_date={batch_date}"


def read_raw_csv(spark: SparkSession, root: str, table: str, batch_date: str,
                 schema: T.StructType | None = None, infer: bool = False) -> DataFrame:
    """One landed CSV batch typed by ``schema``, its columns matched by header name.

    Columns that the files lack are NULL, unknown ones are dropped, and a value that
    does not fit its type is NULL (``uncastable`` counts those). Inference is opt-in
    only: it costs an extra pass and drifts (a digits-only phone column becomes a number).
    """
    path = batch_path(root, table, batch_date)
    if infer:
        return spark.read.options(**CSV_OPTIONS).option("inferSchema", True).csv(path)
    return align_by_name(read_landed(spark, path), schema or RAW_SCHEMAS[table])


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """A landed CSV folder as text, with the columns its header names.

    The header is taken from one file; a file of the folder with another header raises
    (``enforceSchema`` off), as its rows would else be read by position.
    """
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(text).options(**CSV_OPTIONS).option("enforceSchema", False).csv(path)


def uncastable(landed: DataFrame, schema: T.StructType) -> Column:
    """Aggregate: number of text values of ``landed`` that do not fit their column of ``schema``."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    bad = [F.count(F.when(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(types[c.lower()]).isNull(), 1))
           for c in landed.columns if c.lower() in types]
    return reduce(lambda a, b: a + b, bad, F.lit(0).cast("long"))


def read_bronze(spark: SparkSession, root: str, table: str,
                batch_dates: list[str] | None = None) -> DataFrame:
    """All batches of a bronze table; ``batch_date`` comes from the directory
    (typed DATE), and a filter on it prunes whole partitions."""
    path = f"{root.rstrip('/')}/{table}"
    if not path_exists(spark, path):  # an optional table before its first batch
        return spark.createDataFrame([], bronze_schema(table))
    df = spark.read.schema(bronze_schema(table)).parquet(path)
    if batch_dates:
        df = df.where(F.col("batch_date").isin([F.lit(d).cast("date") for d in batch_dates]))
    return df


def latest_batch(df: DataFrame, col: str = "batch_date") -> DataFrame:
    """Rows of the newest batch only.

    ``max(batch_date)`` is a scalar subquery: on a partitioned table its value is a
    partition filter of the scan, so only the newest directory is read.
    """
    return df.where(F.col(col) == df.select(F.max(col)).scalar())


def read_fx_csv(spark: SparkSession, path: str) -> DataFrame:
    """Landed FX rows, all columns as text; ``sources.fx.fx_rates_typed`` types them."""
    return align_by_name(read_landed(spark, path), FX_RAW_SCHEMA)


def read_corrupt_count(spark: SparkSession, path: str, schema: T.StructType,
                       fmt: str = "csv") -> DataFrame:
    """Readability gate: count of rows that do not parse under ``schema``."""
    s = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    reader = (spark.read.schema(s).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record"))
    if fmt == "csv":
        df = reader.options(**CSV_OPTIONS).option("enforceSchema", False).csv(path)
    else:
        df = reader.json(path)
    # a data column is read alongside the corrupt-record column: the parser must
    # run over every row (a query of the corrupt column alone is refused)
    first = F.col(schema.fields[0].name).cast("string")
    bad = F.when(F.col("_corrupt_record").isNotNull(), F.coalesce(first, F.lit("")))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count(bad).alias("corrupt_rows"))


def read_silver(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Every file of a silver dataset (not only the first part file)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{table}")
