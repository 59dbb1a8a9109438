"""Approximate nearest neighbours over learned partitions.

On a bounded sample the neighbour graph is built and cut into balanced parts by recursive
spectral bisection. A small neural classifier learns, for a vector, how its neighbours
spread over the parts. Every row is indexed under its most probable part; a query goes to
its most probable ones, and all rows found there are reranked by exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Bound of the sample that the partitions are learned on.
SAMPLE = 8192
PARTS = 32
GRAPH_DEGREE = 10
HIDDEN = 128
EPOCHS = 40
#: Share of a sample query's true neighbours to be found in the parts it is routed to.
WANTED_RECALL = 0.985
#: Rows of a part, and queries sent to it, that meet in one group, about.
BLOCK_ROWS = 4096
BLOCK_QUERIES = 2048


@dataclass(frozen=True)
class Router:
    """Two-layer classifier from vectors to parts, and how many parts a query visits."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    scale: float
    visits: int

    def parts(self, x: np.ndarray) -> np.ndarray:
        """Parts by falling probability, one row per vector."""
        hidden = np.maximum(x * self.scale @ self.w1 + self.b1, 0)
        return np.argsort(-(hidden @ self.w2 + self.b2), axis=1, kind="stable")


def _nearest(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest other rows, computed in blocks."""
    x = x.astype(np.float32)
    square = (x * x).sum(1)
    out = []
    for at in range(0, len(x), 128):
        d = square[None, :] - 2 * x[at:at + 128] @ x.T
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        out.append(np.argpartition(d, k - 1, axis=1)[:, :k].copy())
    return np.concatenate(out)


def _bisect(x: np.ndarray, graph: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of ``rows`` with few graph edges between them.

    Power iteration on the lazy random walk of the induced graph, started from the main
    direction of the vectors, gives a smooth order of the rows; the median cuts it.
    """
    place = np.full(len(x), -1)
    place[rows] = np.arange(len(rows))
    to = place[graph[rows]]
    a = np.repeat(np.arange(len(rows)), to.shape[1])[to.ravel() >= 0]
    b = to.ravel()[to.ravel() >= 0]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    degree = np.bincount(a, minlength=len(rows)) + 1.0
    centred = x[rows] - x[rows].mean(0)
    y = centred @ np.linalg.svd(centred.T @ centred)[0][:, 0]
    for _ in range(50):
        y = (y + np.bincount(a, y[b], len(rows))) / degree + y
        y -= (y * degree).sum() / degree.sum()
        y /= np.abs(y).max() + 1e-300
    order = np.argsort(y, kind="stable")
    return rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]


def _balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    cells = [np.arange(len(x))]
    while len(cells) < parts:
        cells = [half for cell in cells for half in _bisect(x, graph, cell)]
    label = np.empty(len(x), np.int64)
    for i, cell in enumerate(cells):
        label[cell] = i
    return label


def learn(sample: np.ndarray, k: int = 10, parts: int = PARTS, seed: int = 7) -> Router:
    """Learn parts and their classifier from a sample (rows of float64).

    The number of parts halves until each holds 64 sample rows; with one part every query
    meets every row. ``visits`` is the smallest number of parts that finds WANTED_RECALL of
    the true neighbours of sample rows the classifier wasn't trained on.
    """
    n, dim = sample.shape
    while parts > 1 and n < 64 * parts:
        parts //= 2
    if parts == 1:
        return Router(np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1.0, 1)
    rng = np.random.default_rng(seed)
    # copies of a vector are one vertex, as they would be each other's only neighbours
    x = np.unique(sample, axis=0)
    if len(x) < 64 * parts:
        return learn(x, k, parts // 2, seed)
    graph = _nearest(x, min(GRAPH_DEGREE, len(x) - 1))
    label = _balanced_parts(x, graph, parts)
    spread = np.zeros((len(x), parts))
    np.add.at(spread, (np.arange(len(x)), label), 1.0)
    np.add.at(spread, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].ravel()), 1.0)
    spread /= spread.sum(1, keepdims=True)
    scale = 1 / (x.std() + 1e-12)
    z = x * scale
    order = rng.permutation(len(x))
    test, train = order[:len(x) // 8], order[len(x) // 8:]
    weights = [rng.normal(0, np.sqrt(2 / dim), (dim, HIDDEN)), np.zeros(HIDDEN),
               rng.normal(0, np.sqrt(2 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(EPOCHS):
        for at in np.array_split(rng.permutation(train), max(1, len(train) // 128)):
            hidden = np.maximum(z[at] @ weights[0] + weights[1], 0)
            out = hidden @ weights[2] + weights[3]
            p = np.exp(out - out.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = (p - spread[at]) / len(at)
            back = g @ weights[2].T * (hidden > 0)
            step += 1
            rate = 3e-3 * (1 - epoch / EPOCHS)
            for i, grad in enumerate((z[at].T @ back, back.sum(0), hidden.T @ g, g.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                weights[i] = weights[i] - rate * (first[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    router = Router(*weights, scale, parts)
    ranked = router.parts(x)
    home, near = ranked[:, 0], graph[test][:, :min(k, graph.shape[1])]
    found = [(home[near][:, :, None] == ranked[test][:, None, :v]).any(2).mean() for v in range(1, parts + 1)]
    visits = 1 + int(np.argmax(np.array(found) >= WANTED_RECALL))
    return Router(*weights, scale, visits)


def _routed(router: Router, visits: int):
    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            ranked = router.parts(np.stack(batch["embedding"].to_numpy()).astype(np.float64))[:, :visits]
            yield pd.DataFrame({"vec_id": np.repeat(batch["vec_id"].to_numpy(), ranked.shape[1]),
                                "row": np.repeat(batch["row"].to_numpy(), ranked.shape[1]),
                                "part": ranked.ravel(),
                                "embedding": [e for e in batch["embedding"] for _ in range(ranked.shape[1])]})
    return route


def _reranked(k: int):
    def rerank(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
        ids = rows["vec_id"].to_numpy()
        by_id = np.argsort(ids, kind="stable")
        x, ids = x[by_id], ids[by_id]
        out = []
        for query, q in zip(queries["vec_id"], queries["embedding"], strict=True):
            d = np.sqrt(np.square(x - q.astype(np.float64)).sum(1))
            d[ids == query] = np.inf
            best = np.argsort(d, kind="stable")[:k] if len(d) <= k else None
            if best is None:  # all rows as near as the k-th, so that ties go by id
                best = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
                best = best[np.argsort(d[best], kind="stable")][:k]
            best = best[np.isfinite(d[best])]
            out.append(pd.DataFrame({"query_id": query, "vec_id": ids[best], "score": d[best]}))
        return pd.concat(out)
    return rerank


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, embedding) of rows that can take part: an id, finite components, not all zero,
    and the most frequent number of components."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"),
                     F.col(vector_col).cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0))
    rows = rows.where(~F.coalesce(bad, F.lit(True)) & F.exists("embedding", lambda v: v != 0))
    sizes = rows.groupBy(F.size("embedding").alias("n")).agg(F.count(F.lit(1)).alias("c"))
    dim = sizes.orderBy(F.desc("c"), "n").limit(1).select("n").first()
    return rows.where(F.size("embedding") == (dim[0] if dim else 0))


def search(df: DataFrame, query_every: int = 100, k: int = 10, id_col: str = "vec_id",
           vector_col: str = "embedding", parts: int = PARTS) -> DataFrame:
    """The k nearest rows found for each row whose id ``query_every`` divides: query_id,
    rank, vec_id, score (Euclidean distance in double precision), ties to the smaller id.

    Vectors null, empty, zero, of another length than most, or holding null or non-finite
    components take no part, nor do rows without an id. A row is no candidate for queries
    of its own id; of rows that repeat a query's id the smallest vector asks. An empty
    table gives an empty result. Columns of other names are not read.
    """
    rows = usable(df, id_col, vector_col).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows.select("vec_id", "row", "embedding"), "vectors")
    # at most SAMPLE vectors come to the driver, chosen by a hash
    sample = rows.orderBy(F.xxhash64("vec_id", "row"), "row").limit(SAMPLE).select("embedding").toPandas()
    if sample.empty:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router = learn(np.stack(sample["embedding"].to_numpy()).astype(np.float64), k, parts)
    shape = "vec_id long, row long, part int, embedding array<double>"
    index = written(rows.mapInPandas(_routed(router, 1), shape), "index")
    asked = rows.where(F.col("vec_id") % query_every == 0)
    asked = asked.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("row", F.lit(0).cast("long"))
    queries = written(asked.mapInPandas(_routed(router, router.visits), shape), "queries")

    # blocks bound what meets in a group: a part of any size, and any number of queries
    many = (index.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
            .join(queries.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("chunks")),
                  "part"))
    many = F.broadcast(written(many, "parts"))  # a row for each part
    deal = index.join(many, "part").select(
        "part", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "vec_id", "embedding")
    ask = queries.join(many, "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int").alias("chunk"), "vec_id", "embedding")
    keys = ["part", "block", "chunk"]
    near = ask.groupBy(*keys).cogroup(deal.groupBy(*keys)).applyInPandas(
        _reranked(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
