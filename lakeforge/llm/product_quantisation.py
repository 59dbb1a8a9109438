"""Embedding near-duplicates by product quantisation.

Unit vectors go into coarse inverted lists, one set for each label. A list keeps of each
vector a code of its residual to the list's centroid, a byte for each subspace, and the
residual's quantisation error. A vector asks its own list and, as a probe, every list whose
border with its own lies within half the distance at which vectors link. Of two linked
vectors in different lists at least one is that near to the border between them, so these
probes are sufficient: no link is lost. In a list, distances looked up in a query's
tables, less the errors, exclude rows; exact cosines decide on the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, written

#: Bound of the sample that centroids and codebooks are learned on.
SAMPLE = 16_384
#: Rows of a label's inverted list, about, and the most lists that a sample can give.
LIST_ROWS = 256
MAX_LISTS = 1024
SUBSPACES = 16
CODES = 256
#: Rows of a list, and vectors asking it, that meet in one group; and those compared at once.
BLOCK_ROWS = 4096
BLOCK_QUERIES = 32_768
SLICE = 512
#: Room for rounding in bounds, which are distances of unit vectors.
SLACK = 1e-7


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all rows of ``c``."""
    return np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * x @ c.T, 0)


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """At most ``k`` centroids; an empty one stays where it started."""
    x = np.unique(x, axis=0)
    centre = x[np.random.default_rng(seed).permutation(len(x))[:k]]
    for _ in range(rounds):
        home = np.concatenate([_squares(x[at:at + 4096], centre).argmin(1) for at in range(0, len(x), 4096)])
        count = np.bincount(home, minlength=len(centre))
        total = np.stack([np.bincount(home, column, len(centre)) for column in x.T], 1)
        centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centre)
    return centre


@dataclass(frozen=True)
class Quantiser:
    """Coarse centroids, and for each subspace the codebook of residuals."""

    centroids: np.ndarray
    books: list[np.ndarray]
    cuts: np.ndarray

    @classmethod
    def learn(cls, sample: np.ndarray, lists: int) -> Quantiser:
        centroids = k_means(sample, max(1, min(lists, MAX_LISTS, len(sample) // 16)))
        residual = sample - centroids[_squares(sample, centroids).argmin(1)]
        dim = sample.shape[1]
        cuts = np.linspace(0, dim, min(SUBSPACES, dim) + 1).astype(int)
        books = [k_means(residual[:, a:b], CODES, 6) for a, b in zip(cuts, cuts[1:])]
        return cls(centroids, books, cuts)

    def probes(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """The list of each row, and the lists (boolean) that it asks besides.

        A linked vector of another list lies beyond the plane halfway between the two
        centroids. Two vectors that are ``reach`` apart, one on each side, can't both be
        further than half of that from the plane, so asking within this half is enough.
        """
        d = _squares(x, self.centroids)
        home = d.argmin(1)
        apart = np.sqrt(_squares(self.centroids, self.centroids))[home]
        border = d - d[np.arange(len(x)), home][:, None]
        asks = border <= 2 * apart * (reach / 2 + SLACK) + SLACK
        asks[np.arange(len(x)), home] = False
        return home, asks

    def encode(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the distances to what they stand for."""
        residual = x - self.centroids[home]
        codes, error = np.empty((len(x), len(self.books)), np.uint8), np.zeros(len(x))
        for m, (book, a, b) in enumerate(zip(self.books, self.cuts, self.cuts[1:], strict=False)):
            codes[:, m] = _squares(residual[:, a:b], book).argmin(1)
            error += np.square(residual[:, a:b] - book[codes[:, m]]).sum(1)
        return codes, np.sqrt(error)

    def lookup(self, queries: np.ndarray, part: int, codes: np.ndarray) -> np.ndarray:
        """Distances of queries (rows) to coded vectors of a list (columns), from tables."""
        residual = queries - self.centroids[part]
        total = np.zeros((len(queries), len(codes)), np.float32)
        for m, (book, a, b) in enumerate(zip(self.books, self.cuts, self.cuts[1:], strict=False)):
            total += np.take(_squares(residual[:, a:b], book).astype(np.float32), codes[:, m], axis=1)
        return np.sqrt(total)


def _vectors(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _binary(x: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(x)], pa.binary())


def _indexed(quantiser: Quantiser, reach: float):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                x = _unit(_vectors(batch["embedding"]))
                home, asks = quantiser.probes(x, reach)
                codes, error = quantiser.encode(x, home)
                yield pa.RecordBatch.from_pydict({
                    "node": batch["node"], "label": batch["label"], "w": batch["w"], "part": pa.array(home, pa.int32()),
                    "asks": pa.array([np.flatnonzero(row) for row in asks], pa.list_(pa.int32())),
                    "codes": _binary(codes), "error": pa.array(error), "embedding": batch["embedding"]})
    return index


def _linked(quantiser: Quantiser, least: float, reach: float):
    """Links of one block of a list with the vectors that ask it: for each vector the copies
    it links with here (u, null, n), and who is connected here with whom (u, v, 0)."""
    def link(queries: pa.Table, rows: pa.Table) -> pa.Table:
        shape = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("n", pa.int64())])
        if not queries.num_rows or not rows.num_rows:
            return shape.empty_table()
        part = rows["part"][0].as_py()
        x, q = _unit(_vectors(rows["embedding"])), _unit(_vectors(queries["q_embedding"]))
        node, asking = rows["node"].to_numpy(), queries["q_node"].to_numpy()
        weight, q_weight = rows["w"].to_numpy(), queries["q_w"].to_numpy()
        codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), np.uint8).reshape(len(x), -1)
        limit = (reach + rows["error"].to_numpy() + SLACK * 10).astype(np.float32)
        home = queries["q_part"].to_numpy()
        asked = np.zeros((len(x), len(quantiser.centroids)), bool)
        asks = rows["asks"].to_pylist()
        asked[np.repeat(np.arange(len(x)), [len(a) for a in asks]), [p for a in asks for p in a]] = True
        found, q_found = np.zeros(len(x), np.int64), np.zeros(len(q), np.int64)
        group, q_group = np.arange(len(x)), np.full(len(q), -1)
        for at in range(0, len(q), SLICE):
            s = slice(at, at + SLICE)
            open_ = quantiser.lookup(q[s], part, codes) <= limit
            # each pair once: in one list by the smaller node, else where the smaller list's vector
            # asks, and where it doesn't, by the other
            own = home[s] == part
            open_[own] &= asking[s][own][:, None] < node
            later = home[s] > part
            open_[later] &= ~asked[:, home[s][later]].T
            i = np.flatnonzero(open_.any(1))
            j = np.flatnonzero(open_.any(0))
            if not len(i):
                continue
            hit = (q[s][i] @ x[j].T >= least) & open_[np.ix_(i, j)]
            found[j] += q_weight[s][i] @ hit
            q_found[at + i] += hit @ weight[j]
            a, b = np.nonzero(hit)
            a, b = at + i[a], j[b]
            while len(a):  # rows take the smallest group that a query links them with
                low = np.full(len(q), len(x))
                np.minimum.at(low, a, group[b])
                to = np.arange(len(x))
                np.minimum.at(to, group[b], low[a])
                q_group[a] = low[a]
                if (to[group] == group).all():
                    break
                group = to[group]
        while (group[group] != group).any():
            group = group[group]
        q_group = np.where(q_group >= 0, group[q_group], -1)
        joined, q_joined = np.flatnonzero(group != np.arange(len(x))), np.flatnonzero(q_group >= 0)
        some, q_some = np.flatnonzero(found), np.flatnonzero(q_found)
        u = np.concatenate([node[some], asking[q_some], node[joined], asking[q_joined]])
        v = np.concatenate([np.zeros(len(some) + len(q_some), np.int64), node[group[joined]], node[q_group[q_joined]]])
        n = np.concatenate([found[some], q_found[q_some], np.zeros(len(joined) + len(q_joined), np.int64)])
        return pa.Table.from_arrays([pa.array(u), pa.array(v, mask=n > 0), pa.array(n)], schema=shape)
    return link


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    least: float = 0.93) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id and kept.

    Vectors link when their labels are equal and not null, they have the same number of
    components and their cosine, in double precision, is ``least`` (0 to 1) or more. Null, empty
    and zero vectors and those that hold null or non-finite components link with nothing,
    nor do rows without a label; each is its own component. n_links counts the other rows
    that a row links with, repeated rows and copies included. component_id is the smallest
    id that links reach, null only where they reach no id; kept tells whether it is the
    row's own (a null id is kept only where no other is reached, repeated rows alike). An
    empty table gives an empty result. Other columns of ``df`` are not read.

    Equal vectors of a label are one node with a weight, whatever their number. The sample
    that lists and codebooks are learned on is bounded by SAMPLE; a list of any length is
    dealt into blocks of BLOCK_ROWS, and those who ask it into BLOCK_QUERIES. A group hands
    back counts and its connected vectors, never its pairs.
    """
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                     F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = rows.withColumn("embedding", F.when(F.col("label").isNotNull() & _usable(F.col("embedding")),
                                               F.col("embedding")))
    classes = written(rows.where("embedding is not null").groupBy("label", "embedding")
                      .agg(F.count(F.lit(1)).alias("w"), F.min("vec_id").alias("least_id")), "vector-classes")
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    sizes = [r[0] for r in classes.select(F.size("embedding")).distinct().collect()]
    links = None
    for dim in sorted(sizes):
        found = _links(classes.where(F.size("embedding") == dim), least)
        links = found if links is None else links.unionByName(found)
    if links is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    links = written(links, "vector-links")
    roots = connected_components(links.where("v is not null").select("u", "v"))
    counts = links.where("v is null").groupBy("u").agg(F.sum("n").alias("n"))
    full = classes.join(roots.withColumnRenamed("node", "r_node"), F.col("node") == F.col("r_node"), "left")
    full = full.join(counts, F.col("node") == F.col("u"), "left").select(
        "label", "embedding", "least_id", F.coalesce("root", "node").alias("root"),
        (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    full = written(full, "vector-counts")
    smallest = full.groupBy("root").agg(F.min("least_id").alias("component_id")).withColumnRenamed("root", "of")
    facts = full.join(smallest, F.col("root") == F.col("of")).select(
        F.col("label").alias("f_label"), F.col("embedding").alias("f_embedding"), "n_links", "component_id")
    out = rows.join(facts, (F.col("label") == F.col("f_label")) & (F.col("embedding") == F.col("f_embedding")), "left")
    component = F.when(F.col("f_label").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def _links(classes: DataFrame, least: float) -> DataFrame:
    """(u, v, n) as `_linked` returns them, for classes of one number of components."""
    longest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    # at most SAMPLE vectors come to the driver, chosen by a hash
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding").toArrow()
    quantiser = Quantiser.learn(_unit(_vectors(sample["embedding"])), max(4, longest // LIST_ROWS))
    reach = float(np.sqrt(2 - 2 * least))
    index = written(classes.select("node", "label", "w", "embedding").mapInArrow(
        _indexed(quantiser, reach), "node long, label string, w long, part int, asks array<int>, codes binary, "
        "error double, embedding array<double>"), "vector-index")
    asking = index.select("node", "label", "w", "embedding", "part", F.explode(
        F.concat(F.array("part"), "asks")).alias("at"))
    blocks = index.groupBy("label", "part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    chunks = (asking.groupBy("label", "at")
              .agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("chunks")))
    many = written(blocks.join(chunks.withColumnRenamed("label", "c_label"),
                               (F.col("label") == F.col("c_label")) & (F.col("part") == F.col("at")))
                   .select(F.col("label").alias("m_label"), F.col("part").alias("m_part"), "blocks", "chunks"),
                   "vector-blocks")
    deal = (index.join(many, (F.col("label") == F.col("m_label")) & (F.col("part") == F.col("m_part")))
            .select(F.col("label").alias("k"), F.col("part").alias("at"),
                    F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
                    F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                    "node", "w", "part", "asks", "codes", "error", "embedding"))
    ask = (asking.join(many, (F.col("label") == F.col("m_label")) & (F.col("at") == F.col("m_part")))
           .select(F.col("label").alias("k"), "at",
                   F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                   F.pmod(F.xxhash64("node", F.lit("q")), F.col("chunks")).cast("int").alias("chunk"),
                   *[F.col(c).alias(f"q_{c}") for c in ("node", "w", "part", "embedding")]))
    keys = ["k", "at", "block", "chunk"]
    return ask.groupBy(*keys).cogroup(deal.groupBy(*keys)).applyInArrow(
        _linked(quantiser, least, reach), "u long, v long, n long")
