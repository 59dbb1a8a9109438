"""Writers of every zone: landed CSV, bronze/silver/quarantine parquet, staging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CSV_OPTIONS


def land_csv(df: DataFrame, root: str, table: str, batch_date: str,
             sort_by: Sequence[str] = ()) -> str:
    """Land an extract as header CSV under ``<root>/<table>/batch_date=<d>/``.

    Ordering is per file (``sortWithinPartitions``), never a global sort.
    Re-landing the same batch replaces it.
    """
    path = f"{root.rstrip('/')}/{table}/batch_date={batch_date}"
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    # microseconds stay, so that a row read back from the landing equals the source's
    (out.write.mode("overwrite").options(**CSV_OPTIONS)
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").csv(path))
    return path


def sized(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` dealt out anew, by ``cols`` if given, so that each task writes about one file of
    the advisory size: AQE joins small partitions and splits large ones (``REBALANCE``),
    whatever the number of tasks before. It costs a shuffle of what is written."""
    return df.hint("rebalance", *cols)


def write_partitioned(df: DataFrame, path: str, partition_col: str = "batch_date") -> None:
    """Idempotent write of several partitions: dynamic partition overwrite replaces only the
    directories present in ``df``; older ones stay. Where the partition is known and may come
    out empty, use ``replace_partition``."""
    (sized(df, partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def replace_partition(df: DataFrame, path: str, value: str, partition_col: str = "batch_date") -> None:
    """Write ``df`` as the one partition ``value``, in place of what was there: a rerun without
    rows leaves it empty, not as it was."""
    (sized(df.drop(partition_col)).write.mode("overwrite")
     .parquet(f"{path.rstrip('/')}/{partition_col}={value}"))


def write_bronze(df: DataFrame, root: str, table: str) -> None:
    write_partitioned(df, f"{root.rstrip('/')}/{table}")


def write_full(df: DataFrame, path: str) -> None:
    """Full overwrite (silver tables, quarantine, marts)."""
    sized(df).write.mode("overwrite").parquet(path)


def write_keyed(df: DataFrame, path: str) -> None:
    """Full overwrite by rows that a shuffle by key has dealt out already (the newest per key):
    AQE joins its partitions to the volume, so they are not dealt out a second time."""
    df.write.mode("overwrite").parquet(path)


def write_ordered(df: DataFrame, path: str, order: Sequence[str], files: int | None = None) -> None:
    """Write ``df`` sorted across files: a range of ``order`` per file, sorted inside.

    Readers that filter on the order column skip files and row groups by their footers, and
    one that reads the files by name gets the rows in order. No task holds more than its range.
    """
    cols = [F.col(c) for c in order]
    ranged = df.repartitionByRange(files, *cols) if files else df.repartitionByRange(*cols)
    ranged.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


def align_by_name(df: DataFrame, target: T.StructType) -> DataFrame:
    """Match columns to ``target`` by name, case-insensitively.

    Target columns absent from ``df`` become typed NULLs, columns unknown to
    the target are dropped, every value is cast to the target type
    (``try_cast``: a value that does not fit becomes NULL).
    """
    held = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in target.fields:
        src = held.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif src.dataType == f.dataType:
            cols.append(F.col(f"`{src.name}`").alias(f.name))
        else:
            cols.append(F.col(f"`{src.name}`").try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def append_by_name(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Bag append of ``incoming`` onto ``existing`` by column name (case-insensitive)."""
    return existing.unionByName(align_by_name(incoming, existing.schema))


def append_to_table(incoming: DataFrame, table: str) -> None:
    """Append into a managed table by name (``INSERT INTO t BY NAME`` semantics)."""
    spark = incoming.sparkSession
    target = spark.table(table).schema
    align_by_name(incoming, target).write.mode("append").insertInto(table)


def write_observed(df: DataFrame, path: str, name: str, mode: str = "overwrite") -> int:
    """Write ``df`` and return its row count, taken by the write itself.

    ``Observation`` collects the metric while the rows stream to the sink, so
    the count does not cost a second pass over the data.
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    sized(df.observe(obs, F.count(F.lit(1)).alias("rows"))).write.mode(mode).parquet(path)
    return int(obs.get["rows"])
