"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every row gets the key -ln(u) / quality, u a uniform number from a hash of its id. The
rows of a source are ordered by that key and their sizes prefix-summed; a source takes
as many whole epochs as its target holds, then the rows of the smallest keys until the
rest of the target is filled. As the selection is a prefix of the order, it is stated by
one cut per source, which every row compares with its own key: texts never shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocked_prefix, free_prefix, written

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def text_quality(text: str) -> Column:
    """Share of characters that are not markup or noise signs, at least 0.05."""
    t = F.coalesce(F.col(text), F.lit(""))
    clean = F.length(F.translate(t, "|!#$%&*", ""))
    return F.greatest(F.lit(0.05), clean / F.greatest(F.length(t), F.lit(1)))


def sample_key(id_col: str, quality: Column, seed: str) -> Column:
    """-ln(u) / quality with u in (0, 1) from 52 bits of an MD5 of seed and id."""
    bits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"),
                                      F.coalesce(F.col(id_col).cast("string"), F.lit("null")))), 1, 13)
    u = (F.conv(bits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / quality


def source_targets(sizes: DataFrame, source_col: str, weights: Sequence[float], share: float,
                   cap: float) -> DataFrame:
    """(source, source_size, target): ``share`` of all sizes dealt by weight under the cap.

    Sources in code point order, null last, take the weights in turn. With caps c and
    weights w, a target is min(c, t * w) for the one level t that spends the whole; over
    the sources by c / w that level is the greatest of (whole - caps before) / (weights
    from here on).
    """
    place = F.row_number().over(Window.orderBy(F.col(source_col).asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("_w", w).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    by_fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.col(source_col).asc_nulls_last())
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * F.lit(float(share))
              - F.coalesce(F.sum("_cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("_w").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
    return (ranked.withColumn("_level", level)
            .withColumn("_level", F.max("_level").over(everything))
            .withColumn("target", F.least("_cap", F.col("_level") * F.col("_w")))
            .drop("_w", "_cap", "_level"))


def mix_sources(df: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text", weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                cap: float = 2.0, seed: str = "mix-1") -> DataFrame:
    """``df`` with size, source_size, target, copies and taken (replacing such columns; all
    others stay, whatever their names).

    ``copies`` is how often the mix takes the row, ``taken`` the words this makes. The row
    that crosses the rest of a target is taken if that ends nearer to it. Null texts have
    size 0 and are never counted; a null source is a source of its own, last in order.
    Repeated rows (same id and size) have one key and one fate. An empty table gives an
    empty result; sources of size 0 get target 0. The number of sources may be large, as
    long as one row of numbers per source fits one task.
    """
    df = df.drop("size", "source_size", "target", "copies", "taken")
    p = free_prefix(df)
    of, key, epochs, cut = (f"{p}{c}" for c in ("of", "key", "epochs", "cut"))
    sized = df.withColumns({"size": word_count(text_col),
                            key: sample_key(id_col, text_quality(text_col), seed)})
    narrow = written(sized.select(F.col(source_col).alias("_source"), F.col(id_col).alias("_id"),
                                  "size", F.col(key).alias("_key")), "mix-keys")
    targets = source_targets(narrow.groupBy("_source").agg(F.sum("size").alias("source_size")),
                             "_source", weights, share, cap)
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = written(targets.withColumn("epochs", ratio.cast("long"))
                      .withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size"))
                      .withColumnRenamed("_source", "_of"), "mix-targets")
    summed = blocked_prefix(narrow.where("size > 0"), ["_source"], ["_key", "_id", "size"], "size", "_before")
    cuts = written(summed.join(targets, F.col("_source").eqNullSafe(F.col("_of")))
                   .where(F.col("_before") + F.col("size") / 2 <= F.col("_rest"))
                   .groupBy("_source").agg(F.max(F.struct("_key", "_id", "size")).alias("_cut"))
                   .withColumnRenamed("_source", "_cut_of"), "mix-cuts")
    plan = written(targets.join(cuts, F.col("_of").eqNullSafe(F.col("_cut_of")), "left")
                   .select(F.col("_of").alias(of), "source_size", "target", F.col("epochs").alias(epochs),
                           F.col("_cut").alias(cut)), "mix-plan")
    mine = F.struct(F.col(key).alias("_key"), F.col(id_col).alias("_id"), F.col("size"))
    fits = F.col(cut).isNotNull() & (mine <= F.col(cut))
    return (sized.join(plan, F.col(source_col).eqNullSafe(F.col(of)))
            .withColumn("copies", F.when(F.col("size") > 0, F.col(epochs) + fits.cast("long"))
                        .otherwise(F.lit(0)).cast("long"))
            .withColumn("taken", F.col("size") * F.col("copies"))
            .drop(key, of, cut, epochs))
