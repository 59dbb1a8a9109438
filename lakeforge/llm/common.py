"""Helpers that the corpus operators share: scratch tables, blocked prefix sums, components."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor costs the reading tasks only, and every
    reader sees the same rows even where an expression depends on the row's place.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys``, for grouping keys that may be null."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def free_prefix(df: DataFrame) -> str:
    """Underscores with which no column of ``df`` begins, for helper columns beside its own."""
    prefix = "_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocked_prefix(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
                   out: str) -> DataFrame:
    """Sum of ``value`` over the rows before each row, within ``group`` by ``order``.

    A window over the group alone would put a hot group into one task. Here the rows
    are range-partitioned by (group, order), so a hot group spreads over many blocks;
    the blocks' sums (one row per group and block) get a small prefix sum, and only the
    rows of one block are ordered together. Rows equal in every order column are
    interchangeable. Null groups form a group of their own.
    """
    spark = df.sparkSession
    blocks = 4 * shuffle_partitions(spark)
    placed = written(
        df.repartitionByRange(blocks, *[F.col(c) for c in (*group, *order)])
          .withColumn("_block", F.spark_partition_id()), "blocks")
    before = (Window.partitionBy(*group).orderBy("_block")
              .rowsBetween(Window.unboundedPreceding, -1))
    base = (placed.groupBy(*group, "_block").agg(F.sum(value).alias("_sum"))
            .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
            .drop("_sum"))
    keys = [*group, "_block"]
    inside = (Window.partitionBy(*keys).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    renamed = base.select(*[F.col(k).alias(f"_b_{k}") for k in keys], "_base")
    cond = F.lit(True)
    for k in keys:
        cond = cond & placed[k].eqNullSafe(renamed[f"_b_{k}"])
    joined = placed.join(renamed, cond).drop(*[f"_b_{k}" for k in keys])
    return (joined.withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_base", "_block"))


#: Bits of a block of a Bloom filter: 64 words of 64 bits.
BLOCK_BITS = 4096
#: Most bits of a filter that one broadcast holds (256 MB); a larger one is probed in slices.
SLICE_BITS = 1 << 31


@dataclass(frozen=True)
class BloomFilter:
    """A blocked Bloom filter as a table of blocks (slice, block, bits).

    All hashes of a key fall into one block, so probing is one join. A key belongs to one
    slice by its hash, and a slice is at most SLICE_BITS, about ``bits_per_row`` / 8 bytes
    of broadcast a key, whatever the number of keys.
    """

    blocks: DataFrame
    slices: int
    slice_blocks: int
    hashes: int

    @classmethod
    def of(cls, keys: DataFrame, key: str, at_least: int = 1, hashes: int = 3,
           bits_per_row: int = 16) -> BloomFilter:
        """The bits that at least ``at_least`` rows of ``keys`` hit.

        A bit's hits are counted with a map-side combine, so a key of many rows is one
        row per task. The filter has ``bits_per_row`` bits a row at any table size.
        """
        blocks = 1 << max(4, ((keys.count() * bits_per_row - 1) // BLOCK_BITS).bit_length())
        slices = max(1, blocks * BLOCK_BITS // SLICE_BITS)
        empty = cls(keys, slices, blocks // slices, hashes)
        hit = keys.select(empty._slice(key).alias("slice"), empty._block(key).alias("block"),
                          F.explode(F.array(*[empty._bit(key, i) for i in range(hashes)])).alias("bit"))
        often = hit.groupBy("slice", "block", "bit").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least)
        words = often.groupBy("slice", "block", F.shiftright("bit", 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, bit & 63)")).alias("bits"))
        held = words.groupBy("slice", "block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
        bits = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)),
                           lambda w: F.coalesce(F.col("m")[w], F.lit(0).cast("long")))
        return cls(written(held.select("slice", "block", bits.alias("bits")), "bloom"), slices, blocks // slices, hashes)

    def _slice(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key), F.lit("slice")), F.lit(self.slices)).cast("int")

    def _block(self, key: str) -> Column:
        return F.xxhash64(F.col(key), F.lit("block")).bitwiseAND(F.lit(self.slice_blocks - 1))

    def _bit(self, key: str, i: int) -> Column:
        return F.xxhash64(F.col(key), F.lit(i)).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int")

    def probe(self, rows: DataFrame, key: str, out: str) -> DataFrame:
        """``rows`` with boolean ``out``: whether all bits of ``key`` are set.

        Rows are never shuffled: each slice of the filter is broadcast, and its rows pass by.
        With several slices ``rows`` are read once for each.
        """
        p = free_prefix(rows)
        block, bits, at = f"{p}block", f"{p}bits", f"{p}at"
        hits = [self._bit(key, i) for i in range(self.hashes)]
        found = reduce(lambda a, b: a & b, [
            F.get(bits, F.shiftright(h, 6)).bitwiseAND(F.call_function(
                "shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)))) != 0 for h in hits])
        parts = []
        for n in range(self.slices):
            side = self.blocks.where(F.col("slice") == n).select(F.col("block").alias(block), F.col("bits").alias(bits))
            mine = rows if self.slices == 1 else rows.where(self._slice(key) == n)
            joined = mine.withColumn(at, self._block(key)).join(F.broadcast(side), F.col(at) == F.col(block), "left")
            parts.append(joined.withColumn(out, F.coalesce(found, F.lit(False))).drop(at, block, bits))
        return reduce(DataFrame.unionByName, parts)


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (u, v) but the roots themselves.

    Alternating large-star and small-star steps: each step joins the edges with the smallest
    neighbour of their node (a map-side combined minimum) and is written to the shared
    folder, so nothing passes through the driver but a checksum per step. Both sides of the
    join are plain exchanges, so a hub's edges can be split by skew joins. When neither step
    changes anything, every edge leads from a node to its component's smallest.
    """
    def canonical(e: DataFrame) -> DataFrame:
        return (e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .where("u <> v").distinct())

    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e if small else e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        hung = both.join(least, both.u == least.n)
        if small:
            return canonical(hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
                             .union(least.select(F.col("n").alias("u"), F.col("m").alias("v"))))
        return canonical(hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))

    def checksum(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    now = written(canonical(edges), "edges")
    seen, still, step = checksum(now), 0, 0
    while seen[0] and still < 2:
        if step == 2 * rounds:
            raise RuntimeError(f"components not settled after {rounds} rounds")
        now = written(star(now, small=step % 2 == 1), "star")
        found = checksum(now)
        still, seen, step = still + 1 if found == seen else 0, found, step + 1
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
