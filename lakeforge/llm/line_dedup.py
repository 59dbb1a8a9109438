"""Line dedup by content-defined chunks of lines.

Every line is hashed; a rolling hash over two neighbouring lines decides whether a chunk
goes on from one to the other. It ends there where that hash occurs nowhere else in the
corpus, as no repeated chunk can span such a place; so a passage that many documents share
starts and ends alike wherever it stands. Further phases, each with its own seed, also end
chunks where ``divisor`` divides the hash, which meets documents that hold a passage in
part. Chunks of two lines or more, and single lines of more than ``long_words`` words, that
occur again anywhere are compared byte by byte with the first of their occurrences, and all
but that one are removed.

With ``every_pair`` a last step follows: of what the phases left, each repeated pair of lines
is a chunk of its own, the smallest there is. So a passage goes whole also where the pairs at
its rims occur elsewhere and the phases ended its chunks differently in its documents.

A line goes only because of an equal line in a smaller document, or further up in its
own, so the first occurrence of every line stays somewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BloomFilter, free_prefix, written

UNIT = "array<struct<a: int, z: int, h: bigint>>"


def _units(long_words: int) -> Column:
    """Neighbouring lines (a, z = a + 1) and long lines (a = z) with their hashes, from _lines and _h."""
    pairs = ("transform(sequence(0, size(_h) - 2), "
             "i -> struct(i as a, i + 1 as z, xxhash64(_h[i], _h[i + 1]) as h))")
    # words of a line are counted by the blanks between them
    many = (f"length(_lines[i]) > {2 * long_words} and "
            f"length(_lines[i]) - length(replace(_lines[i], ' ', '')) >= {long_words}")
    alone = (f"transform(filter(sequence(0, size(_h) - 1), i -> {many}), "
             "i -> struct(i as a, i as z, xxhash64(_h[i]) as h))")
    return F.expr(f"concat(cast(if(size(_h) > 1, {pairs}, array()) as {UNIT}), cast({alone} as {UNIT}))")


def _chunks(units: DataFrame, phases: int, divisor: int) -> DataFrame:
    """Distinct chunks (_key, a, z, h) of all phases, from distinct units (_key, a, z, h).

    A chunk is a run of pairs that follow each other; a phase leaves out the pairs at
    which it cuts, the first phase none. Long lines are chunks as they are. The windows
    and groupings all follow the one shuffle by _key.
    """
    placed = units.repartition("_key")
    cut = [F.when(F.pmod(F.xxhash64("h", F.lit(s)), F.lit(divisor)) != 0, s) for s in range(1, phases)]
    pairs = (placed.where("a < z").withColumn("s", F.explode(F.array(F.lit(0), *cut)))
             .where(F.col("s").isNotNull()))
    along = Window.partitionBy("_key", "s").orderBy("a")
    begins = F.col("prev").isNull() | (F.col("prev") != F.col("a") - 1)
    runs = (pairs.withColumn("prev", F.lag("a").over(along))
            .withColumn("start", F.last(F.when(begins, F.col("a")), ignorenulls=True).over(along)))
    unit = F.xxhash64("h", F.col("a") - F.col("start"))
    found = (runs.groupBy("_key", "s", "start")
             .agg(F.max("z").alias("z"), F.bit_xor(unit).alias("x"))
             .select("_key", F.col("start").alias("a"), "z", F.xxhash64("x", F.col("z") - F.col("start")).alias("h"))
             .distinct())
    return found.union(units.where("a = z").select("_key", "a", "z", "h"))


def _long_runs(lines: DataFrame, min_chars: int) -> DataFrame:
    """Those of the ``lines`` (_key, line, size) whose runs have ``min_chars`` characters; line
    feeds inside of a run count."""
    lines = lines.repartition("_key").distinct()
    down = Window.partitionBy("_key").orderBy("line")
    run = F.col("line") - F.row_number().over(down)
    whole = F.sum(F.col("size") + 1).over(Window.partitionBy("_key", "run")) - 1
    return (lines.withColumn("run", run).withColumn("chars", whole)
            .where(F.col("chars") >= min_chars).select("_key", "line"))


def _repeated(units: DataFrame) -> DataFrame:
    """Those of the ``units`` (_key, a, z, h) whose hash occurs at two places at least; repeated
    rows are one place."""
    place = F.xxhash64("_key", "a")
    often = written(units.groupBy("h").agg(F.min(place).alias("one"), F.max(place).alias("other"))
                    .where("one <> other").select("h"), "repeated-units")
    return units.join(often, "h").select("_key", "a", "z", "h").distinct()


def _later_equals(texts: DataFrame, chunks: DataFrame, min_chars: int) -> DataFrame:
    """(_key, a, sizes): which of the ``chunks`` (_key, a, z) equal, byte by byte, one that
    comes before, and the lengths of their lines. ``texts`` are (_key, _id, _text)."""
    suspects = written(chunks.groupBy("_key").agg(F.collect_set(F.struct("a", "z")).alias("_c")), "suspects")
    # a Bloom filter of the keys keeps the texts of other documents out of the shuffle
    near = BloomFilter.of(suspects, "_key").probe(texts, "_key", "_may")
    # merge joins at any size: both sides grow with the documents, whatever a small input allows
    spelled = (near.where("_may").join(suspects.hint("merge"), "_key").dropDuplicates(["_key"])
               .withColumn("_lines", F.split(F.coalesce("_text", F.lit("")), "\n", -1))
               .select("_key", "_id", "_lines", F.explode("_c").alias("c"))
               .select("_key", "_id", "c.a", F.expr("slice(_lines, c.a + 1, c.z - c.a + 1)").alias("held"))
               .select("_key", "_id", "a", F.array_join("held", "\n").alias("chunk"),
                       F.transform("held", lambda x: F.length(x)).alias("sizes"))
               .where(F.length("chunk") >= min_chars))
    spelled = written(spelled, "occurrences")
    # grouping by the chunk compares its bytes; its digest then names the group to narrow rows
    digest = F.unhex(F.sha2("chunk", 256)).alias("d")
    first = written(spelled.groupBy("chunk").agg(F.min(F.struct("_id", "_key", "a")).alias("f"),
                                                 F.count(F.lit(1)).alias("n")).where("n > 1").select(digest, "f"),
                    "first")
    later = (F.col("_key") != F.col("f._key")) | (F.col("a") != F.col("f.a"))
    return spelled.select("_key", "a", "sizes", digest).join(first, "d").where(later).select("_key", "a", "sizes")


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = 2,
                phases: int = 4, min_chars: int = 40, long_words: int = 50,
                every_pair: bool = False) -> DataFrame:
    """``df`` with its text less repeated chunks, and lines_before and lines_removed
    (replacing columns of these names; all others stay, whatever their names).

    Lines end at line feeds. Chunks shorter than ``min_chars`` are left, and so are single
    lines of up to ``long_words`` words; with ``every_pair`` it is the runs of removed lines
    that must have ``min_chars``, and ``divisor`` and ``phases`` do not change the result. The
    first occurrence is that of the smallest id (null ids first), then the smallest text hash,
    then the highest up. Rows stay even where nothing of their text is left (then it is empty). A null text stays null and has
    no line; an empty one is one empty line. Repeated rows (same id and text) count as one
    document and have one result. An empty table gives an empty result; very long texts
    are cut whole.
    """
    df = df.drop("lines_before", "lines_removed")
    p = free_prefix(df)
    key, may, held, of = f"{p}key", f"{p}may", f"{p}gone", f"{p}of"
    keyed = df.withColumn(key, F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"),
                                         F.hex(F.xxhash64(F.coalesce(text_col, F.lit(""))))))
    lines = F.split(F.coalesce(text_col, F.lit("")), "\n", -1)
    units = written(keyed.select(F.col(key).alias("_key"), lines.alias("_lines"))
                    .withColumn("_h", F.transform("_lines", lambda x: F.xxhash64(x)))
                    .select("_key", F.explode(_units(long_words)).alias("u")).select("_key", "u.*"), "line-units")
    texts = keyed.select(F.col(key).alias("_key"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    met = written(_repeated(units), "met-units")
    chunks = written(_chunks(met, phases, divisor), "chunks")
    again = written(chunks.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"),
                    "repeated-chunks")
    later = written(_later_equals(texts, chunks.join(again, "h"), 0 if every_pair else min_chars), "later-chunks")
    gone = later.select("_key", F.posexplode("sizes").alias("i", "size"), "a").select(
        "_key", (F.col("a") + F.col("i")).alias("line"), "size")
    if every_pair:
        # units within chunks that go are later than equal ones that stay, so no first one is missed
        inside = F.sequence(F.lit(0), F.greatest(F.size("sizes") - 2, F.lit(0)))
        covered = later.select("_key", F.explode(F.transform(inside, lambda i: F.struct(
            (F.col("a") + i).alias("a"), (F.col("a") + F.least(i + 1, F.size("sizes") - 1)).alias("z")))).alias("u"))
        left = written(met.join(covered.select("_key", "u.*"), ["_key", "a", "z"], "left_anti"), "left-units")
        pairs = _later_equals(texts, _repeated(left), 0)
        gone = _long_runs(gone.union(pairs.select("_key", F.posexplode("sizes").alias("i", "size"), "a").select(
            "_key", (F.col("a") + F.col("i")).alias("line"), "size")), min_chars)
    gone = written(gone.groupBy(F.col("_key").alias(of)).agg(F.collect_set("line").alias(held)), "removed")
    rows = BloomFilter.of(gone, of).probe(keyed, key, may)
    every, left, lost = f"{p}lines", f"{p}left", F.col(held).isNotNull()
    before = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(every)).alias("lines_before")
    untouched = (rows.where(~F.col(may)).withColumn(every, lines)
                 .select("*", before, F.lit(0).alias("lines_removed")).drop(every))
    numbers = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(held))
    touched = (rows.where(F.col(may)).join(gone.hint("merge"), F.col(key) == F.col(of), "left")
               .withColumn(every, lines)
               .select("*", before, F.when(lost, F.transform(numbers, lambda i: F.col(every)[i]))
                       .otherwise(F.col(every)).alias(left))
               .withColumn("lines_removed", F.size(every) - F.size(left))
               .withColumn(text_col, F.when(lost, F.array_join(left, "\n")).otherwise(F.col(text_col)))
               .drop(of, held, left, every))
    return untouched.unionByName(touched).drop(key, may)
