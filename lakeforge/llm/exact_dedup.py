"""Exact dedup: a Bloom filter of repeated slots finds the rows that may have a copy.

Pass one maps the SHA-256 of every text to a few slots of a Bloom filter and keeps the
slots that at least two rows hit. Pass two probes that filter: a row with a slot that no
other row hit cannot have a copy and passes straight through; only the others shuffle.
False positives of the filter cost a little shuffle and never change the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BloomFilter, free_prefix, written


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hashes: int = 3, bits_per_row: int = 16) -> DataFrame:
    """``df`` with keep_id, group_size, kept and text_sha256 (existing columns of these
    names are replaced; all others stay, whatever their names).

    Of rows with the same text the one with the largest id stays. Null texts count as
    empty; all empty texts are copies of each other. A null id never stays while its
    group has another id. Repeated rows (same id and text) have one fate and count each
    in group_size. Nothing is dropped here: filter on ``kept``. An empty table gives an
    empty result. Very long texts are hashed whole.
    """
    df = df.drop("keep_id", "group_size", "kept", "text_sha256")
    p = free_prefix(df)
    mine, maybe, group = f"{p}digest", f"{p}maybe", f"{p}group"
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    keys = written(df.select(F.col(id_col).alias("_id"), digest.alias("_digest")), "text-keys")
    repeated = BloomFilter.of(keys, "_digest", 2, hashes, bits_per_row)
    groups = written(repeated.probe(keys, "_digest", "_maybe").where("_maybe").groupBy(F.col("_digest").alias(group))
                     .agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "copy-groups")
    rows = repeated.probe(df.withColumn(mine, digest), mine, maybe)
    single = (rows.where(~F.col(maybe))
              .withColumns({"keep_id": F.col(id_col), "group_size": F.lit(1).cast("long")}))
    several = rows.where(F.col(maybe)).join(groups, F.col(mine) == F.col(group)).drop(group)
    return (single.unionByName(several)
            .withColumns({"kept": F.col(id_col).eqNullSafe(F.col("keep_id")),
                          "text_sha256": F.lower(F.hex(mine))})
            .drop(mine, maybe))
