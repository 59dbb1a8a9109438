"""Near-duplicate documents by HyperMinHash.

A document is its set of distinct 5-word shingles, hashed to 64 bits. Its sketch has 128
buckets; of the smallest hash of each bucket it stores the number of leading zeros and
the next 10 bits. Bands of 4 compressed registers make candidates: at a similarity of
0.85 a pair shares no band of the 32 with probability 6e-11.

Copies collapse to one class before anything else, so a class is a row whatever its
size. Members of a band's bucket are not paired with each other: each is compared with
the bucket's leader, the class whose bands are shared most (in a family of edited copies
the least edited one). What this leaves open is settled exactly: shingles found in one
class only bound a class's similarity to any other, and buckets that still hold several
components which those bounds allow to link are compared in blocks of bounded size. Every
link is confirmed on the full shingle sets, after the collision-corrected estimate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BloomFilter, connected_components, written

WORDS = 5
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BAND_ROWS = 4
BANDS = BUCKETS // BAND_ROWS
BLOCK = 256
#: Expected share of equal registers of two unrelated sets of one size, times 2 ** MANTISSA_BITS.
RANDOM_MATCH = 0.1699
#: Distinct words whose hashes a Python worker remembers.
WORD_CACHE = 200_000
#: Rows that a Python worker hands back at once.
OUT_ROWS = 1000

_ASCII_LOWER = bytes(range(256)).lower()


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, hashes: dict) -> tuple[np.ndarray, bytes]:
    """Sorted distinct shingle hashes of a whole text, and a digest of its word sequence."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_ASCII_LOWER).split()
    n = len(words)
    digest = xxhash.xxh3_128_digest(b" ".join(words))
    if not n:
        return np.empty(0, np.uint64), digest
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    step = np.uint64(0x9E3779B97F4A7C15)
    span = min(n, WORDS)
    acc = np.full(n - span + 1, span, np.uint64)
    for i in range(span):
        acc = _mixed(acc * step + h[i:n - span + 1 + i])
    return np.unique(acc), digest


def registers(hashes: np.ndarray) -> np.ndarray:
    """Compressed registers of sorted hashes; empty buckets borrow from the next filled one."""
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    filled, first = np.unique(bucket, return_index=True)
    rest = (hashes[first] << np.uint64(BUCKET_BITS)) >> np.uint64(12)
    zeros = 52 - np.frexp(rest.astype(np.float64))[1]
    after = (rest << np.minimum(zeros + 13, 63).astype(np.uint64)) >> np.uint64(64 - MANTISSA_BITS)
    value = (zeros.astype(np.int32) << MANTISSA_BITS) | after.astype(np.int32)
    place = np.searchsorted(filled, np.arange(BUCKETS)) % len(filled)
    return value[place]


def similarity_estimate(matches: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimate from equal registers, less the matches that chance makes."""
    chance = RANDOM_MATCH * 2.0 ** -MANTISSA_BITS * 4 * n * m / np.square(n + m, dtype=np.float64)
    return (matches / BUCKETS - chance) / (1 - chance)


def estimate_floor(percent: int, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The estimate below which a pair at the threshold falls once in some million times."""
    t = percent / 100
    return t - 5 * np.sqrt(t * (1 - t) / np.minimum(BUCKETS, np.minimum(n, m)))


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), OUT_ROWS):
            yield batch.iloc[at:at + OUT_ROWS]


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = _WordHashes()
    for rows in _slices(batches):
        out = []
        for text in rows["text"]:
            found, digest = shingles(text, hashes)
            out.append((digest, len(found), registers(found) if len(found) else np.empty(0, np.int32)))
        yield pd.DataFrame({"id": rows["id"].to_numpy(), "row_key": rows["row_key"].to_numpy(),
                            "digest": [x[0] for x in out], "n": [x[1] for x in out], "regs": [x[2] for x in out]})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = _WordHashes()
    for rows in _slices(batches):
        yield pd.DataFrame({"node": rows["digest"].to_numpy(),
                            "sh": [shingles(t, hashes)[0].view(np.int64) for t in rows["text"]]})


def _block_pairs(percent: int):
    """Pairs of two blocks of a bucket that may link: of different components, not excluded
    by their bounds, similar by estimate, and not already met in an earlier band."""
    def pairs(group: pd.DataFrame) -> pd.DataFrame:
        regs = np.stack(group["regs"].to_numpy()).astype(np.int32)
        n, u = group["n"].to_numpy(np.int64), group["u"].to_numpy(np.int64)
        root, node = group["root"].to_numpy(), group["node"].to_numpy()
        side, band = group["side"].to_numpy(), int(group["band"].iloc[0])
        one_block = bool((group["lo"] == group["hi"]).iloc[0])
        shared = n - u
        out = []
        for i in range(len(group)):
            j = np.arange(i + 1, len(group)) if one_block else np.flatnonzero(side > side[i])
            j = j[root[j] != root[i]]
            j = j[100 * np.minimum(shared[i], shared[j])
                  >= percent * (u[i] + u[j] + np.maximum(shared[i], shared[j]))]
            if not len(j):
                continue
            equal = regs[j] == regs[i]
            est = similarity_estimate(equal.sum(1), n[i], n[j])
            first = equal.reshape(len(j), BANDS, BAND_ROWS).all(2).argmax(1)
            j = j[(est >= estimate_floor(percent, n[i], n[j])) & (first == band)]
            out += [(node[i], node[k]) for k in j]
        return pd.DataFrame(out, columns=["a", "b"])
    return pairs


def _estimated(percent: int):
    def near(a: pd.Series, b: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        equal = (np.stack(a.to_numpy()) == np.stack(b.to_numpy())).sum(1)
        n, m = n.to_numpy(), m.to_numpy()
        return pd.Series(similarity_estimate(equal, n, m) >= estimate_floor(percent, n, m))
    return F.pandas_udf(near, "boolean")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    a = sets.select(F.col("node").alias("a"), F.col("sh").alias("sa"), F.col("regs").alias("ra"),
                    F.col("n").alias("na"))
    b = sets.select(F.col("node").alias("b"), F.col("sh").alias("sb"), F.col("regs").alias("rb"),
                    F.col("n").alias("nb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(a, "a").join(b, "b")
            .where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
                   & _estimated(percent)("ra", "rb", "na", "nb"))
            .withColumn("both", both)
            .where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both")))
            .select(F.col("a").alias("u"), F.col("b").alias("v")))


def _band_key(band: Column) -> Column:
    return F.xxhash64(F.slice("regs", band * BAND_ROWS + 1, BAND_ROWS), band)


def row_key(id_col: str, text_col: str) -> Column:
    """Hash of id and text, by which near_duplicates names a row."""
    return F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 85) -> DataFrame:
    """One row per row of ``df``: the id, row_key, n_shingles, component_id and kept.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Documents link when
    100 * intersection >= percent * union of their shingle sets; a document of fewer than
    five words has its whole sequence as one shingle. Null and empty texts have no shingle
    and link with nothing, each its own component. component_id is the smallest id that a
    document reaches by links (null only where it reaches no id); a null id is never kept
    where its component has another. Repeated rows (same id and text) have one fate. Other
    columns of ``df`` are not read, whatever their names; join them back by row_key.
    Ties do not matter: components do not depend on the order of rows. Very long texts
    are taken whole. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # ids as strings in Python: pandas would turn longs with nulls into floats
    docs = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"),
                     row_key(id_col, text_col).alias("row_key"))
    sketched = written(docs.withColumn("id", F.col("id").cast("string")).mapInPandas(
        _sketches, "id string, row_key long, digest binary, n long, regs array<int>")
        .withColumn("id", F.col("id").cast("long")), "sketches")
    classes = written(
        sketched.where("n > 0").groupBy("digest")
        .agg(F.min("id").alias("id"), F.min(F.struct("id", "row_key")).alias("of"),
             F.first("n").alias("n"), F.first("regs").alias("regs")), "classes")

    banded = classes.select(F.col("digest").alias("node"), F.posexplode(F.array(
        *[_band_key(F.lit(b)) for b in range(BANDS)])).alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = written(banded.join(shared, ["band", "key"]), "members")
    scores = met.groupBy("node").agg(F.sum("members").alias("score"))

    chosen = written(classes.join(scores, classes.digest == scores.node)
                     .select("node", "score", "n", "regs", F.col("of.id").alias("id"),
                             F.col("of.row_key").alias("row_key")), "chosen")
    # whole texts of the chosen classes: a Bloom filter keeps the others from the shuffle
    wanted = chosen.select("node", F.col("id").alias("w_id"), F.col("row_key").alias("w_key"))
    near = BloomFilter.of(wanted, "w_key").probe(docs, "row_key", "may").where("may")
    texts = (near.join(wanted, (F.col("row_key") == F.col("w_key")) & F.col("id").eqNullSafe(F.col("w_id")))
             .groupBy("row_key", "id").agg(F.first("node").alias("digest"), F.first("text").alias("text"))
             .select("digest", "text"))
    sets = written(texts.mapInPandas(_sets, "node binary, sh array<long>"), "sets")

    # shingles that no other chosen class has bound the similarity to any of them
    own = (sets.select("node", F.explode("sh").alias("s")).groupBy("s")
           .agg(F.count(F.lit(1)).alias("c"), F.first("node").alias("node")).where("c = 1")
           .groupBy("node").agg(F.count(F.lit(1)).alias("u")))
    facts = written(chosen.select("node", "score", "n", "regs").join(own, "node", "left")
                    .withColumn("u", F.coalesce("u", F.lit(0)))
                    .where(100 * (F.col("n") - F.col("u")) >= percent * F.col("n")), "facts")
    sets = written(sets.join(facts.select("node", "n", "regs"), "node"), "linked-sets")
    met = written(met.select("band", "key", "node")
                  .join(facts.select("node", "score", "n", "u"), "node"), "linkable")

    leaders = (met.groupBy("band", "key").agg(F.max(F.struct("score", "node")).alias("l"), F.count(F.lit(1)).alias("c"))
               .where("c > 1").select("band", "key", F.col("l.node").alias("b")))
    spokes = (met.join(leaders, ["band", "key"]).where("node <> b")
              .select(F.col("node").alias("a"), "b").distinct())
    roots = connected_components(_confirmed(spokes, sets, percent))

    # what the leaders leave open links whole components
    rest = _open_pairs(met, roots, facts, percent)
    over = None
    if rest is not None:
        more = _confirmed(rest, sets, percent)
        for end in ("u", "v"):
            of = roots.select(F.col("node").alias("r_node"), F.col("root").alias("r_root"))
            more = (more.join(of, F.col(end) == F.col("r_node"), "left")
                    .withColumn(end, F.coalesce("r_root", end)).drop("r_node", "r_root"))
        over = connected_components(more).select(F.col("node").alias("o_node"), F.col("root").alias("o_root"))

    rooted = classes.select("digest", "n", "id").join(roots, F.col("digest") == F.col("node"), "left")
    rooted = rooted.select("digest", "n", "id", F.coalesce("root", "digest").alias("root"))
    if over is not None:
        rooted = (rooted.join(over, F.col("root") == F.col("o_node"), "left")
                  .select("digest", "n", "id", F.coalesce("o_root", "root").alias("root")))
    rooted = written(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id")).withColumnRenamed("root", "of")
    found = (rooted.join(least, F.col("root") == F.col("of"))
             .select(F.col("digest").alias("c_digest"), "component_id"))
    rows = (sketched.where("n > 0").join(found, F.col("digest") == F.col("c_digest"))
            .select("id", "row_key", "n", "component_id")
            .unionByName(sketched.where("n = 0")
                         .select("id", "row_key", "n", F.col("id").alias("component_id"))))
    return rows.select(F.col("id").alias(id_col), "row_key", F.col("n").alias("n_shingles"),
                       "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _open_pairs(met: DataFrame, roots: DataFrame, facts: DataFrame, percent: int) -> DataFrame | None:
    """Candidate pairs of buckets that hold several components, after the bounds (None: there
    are none).

    A class of n shingles, u of them its own, can link only with sizes m where
    100 * m >= percent * n and percent * (m + u) <= 100 * (n - u). Members without such a
    size in their bucket leave it. The rest of a bucket is dealt into blocks of about 256;
    each pair of blocks is one group.
    """
    def mixed(members: DataFrame) -> DataFrame:
        return (members.groupBy("band", "key")
                .agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.collect_set("n").alias("sizes"),
                     F.count(F.lit(1)).alias("members"))
                .where("r0 <> r1").select("band", "key", "sizes", "members"))

    rooted = met.join(roots.withColumnRenamed("node", "r_node"), F.col("node") == F.col("r_node"), "left")
    left = written(rooted.select("band", "key", "node", "n", "u",
                                 F.coalesce("root", "node").alias("root")), "rooted-members")
    for _ in range(2):
        left = written(left.join(mixed(left), ["band", "key"]).where(
            F.exists("sizes", lambda m: (100 * m >= percent * F.col("n"))
                     & (percent * (m + F.col("u")) <= 100 * (F.col("n") - F.col("u")))))
            .select("band", "key", "node", "n", "u", "root"), "open-members")
        if left.isEmpty():
            return None
    still = mixed(left).drop("sizes")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    side = F.pmod(F.xxhash64("node", F.lit("side")), F.col("blocks")).cast("int")
    dealt = (left.join(still, ["band", "key"]).withColumn("blocks", blocks).withColumn("side", side)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other"))
             .join(facts.select("node", "regs"), "node"))
    return (dealt.groupBy("band", "key", "lo", "hi")
            .applyInPandas(_block_pairs(percent), "a binary, b binary").distinct())
