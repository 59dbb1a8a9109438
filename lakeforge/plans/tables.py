"""Models as tables of the catalog, bucketed by the key they are joined on.

A bucketed table is shuffled once, when it is written. Readers that join or rank by the
bucket key then read each bucket in one task, without an exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schemas import SPECS
from .registry import Context

#: Models that meet on an order, by the order they belong to, and the products that items lack.
#: Each may read those before it.
FACT_TABLES = {"latest_order_heads": "order_id", "fact_orders": "order_id", "latest_order_items": "order_id",
               "unknown_products": "product_id"}


def save_table(df: DataFrame, name: str, bucket_by: str, buckets: int, path: str | None = None,
               sort_by: Sequence[str] = ()) -> None:
    """Write ``df`` as table ``name`` in ``buckets`` buckets of a column, each sorted.

    The rows are dealt out by the bucket key first, so every bucket is one file, not one
    per task that wrote into it. ``path`` makes it an external table.
    """
    writer = (df.repartition(buckets, bucket_by).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, bucket_by).sortBy(*(sort_by or [bucket_by])))
    (writer.option("path", path) if path else writer).saveAsTable(name)


def default_buckets(spark: SparkSession) -> int:
    """As many buckets as a shuffle has partitions, up to what the session allows."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")),
               int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))


def _table(spark: SparkSession, database: str, name: str, root: str | None) -> tuple[str, str | None]:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    return f"{database}.{name}", f"{root.rstrip('/')}/{name}" if root else None


def save_sources(ctx: Context, database: str, buckets: int | None = None, root: str | None = None) -> None:
    """The bronze tables as tables of ``database``, each bucketed by its key: the pick of the
    newest row per key then needs no shuffle."""
    for t, spec in SPECS.items():
        name, path = _table(ctx.spark, database, t, root)
        save_table(ctx.source(t), name, spec.key, buckets or default_buckets(ctx.spark), path)


def table_context(spark: SparkSession, database: str, fx_rates: DataFrame, **options) -> Context:
    """Context whose sources are the tables of ``database``, by name."""
    def bronze(name: str) -> DataFrame:
        return fx_rates if name == "fx_rates" else spark.table(f"{database}.{name}")

    return Context(spark, bronze, dict(options))


def with_fact_tables(ctx: Context, database: str, buckets: int | None = None, root: str | None = None) -> Context:
    """``ctx`` with the models that the fact joins on an order written as bucketed tables and
    read from there; items and orders then meet first, bucket by bucket. Orders have met their
    dimensions before, so no item is shuffled for those."""
    out = Context(ctx.spark, ctx.bronze, ctx.options | {"bucketed": True})
    for m, key in FACT_TABLES.items():
        name, path = _table(ctx.spark, database, m, root)
        save_table(out.ref(m), name, key, buckets or default_buckets(ctx.spark), path)
        out._cache[m] = ctx.spark.table(name)
    return out
