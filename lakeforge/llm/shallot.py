"""Exact k-means in integers, with Shallot's bounded search for the two nearest centroids.

Every vector carries an upper bound of its distance to its centroid, a lower bound of the
distance to any other, and which centroid was the second nearest. After the centroids
have moved, the bounds move with them; where they still tell the nearest centroid, the
vector is left alone. Else both remembered centroids are measured and the search starts at
the closer one, goes through its neighbours by distance, and ends where a neighbour lies
outside the ball that the two nearest found so far leave open, which shrinks as it goes.
Distances are compared as integers; bounds only ever exclude what is surely further.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Components up to this keep squared distances of 64 of them within a long.
LARGEST = 1 << 27
#: Relative room for rounding in bounds, and rows searched at once.
SLACK = 1e-12
ROWS = 8192

STATE = "row long, vec_id long, vector array<int>, cluster int, second int, upper double, lower double, distance long"


@dataclass(frozen=True)
class Centroids:
    """Integer centroids, each one's neighbours by distance, and how far each has moved."""

    at: np.ndarray
    apart: np.ndarray
    order: np.ndarray
    moved: np.ndarray

    @classmethod
    def of(cls, at: np.ndarray, before: np.ndarray | None = None) -> Centroids:
        apart = np.stack([_distance(np.square(at - c).sum(1)) for c in at])
        order = np.argsort(apart, axis=1, kind="stable")
        # a centroid is its own first neighbour, also where another one equals it
        for i, row in enumerate(order):
            order[i] = np.concatenate([[i], row[row != i]])
        moved = np.zeros(len(at)) if before is None else _distance(np.square(at - before).sum(1))
        return cls(at, apart * (1 - SLACK), order, moved * (1 + SLACK))

    def furthest_other(self) -> np.ndarray:
        """For each centroid how far any other has moved at most."""
        if len(self.moved) < 2:
            return np.zeros(len(self.moved))
        first, second = np.argsort(-self.moved, kind="stable")[:2]
        out = np.full(len(self.moved), self.moved[first])
        out[first] = self.moved[second]
        return out


def _distance(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


def search(x: np.ndarray, c: Centroids, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """The nearest centroid of each row (ties: the smaller number), the next one, and both
    squared distances, starting from two centroids for each row."""
    k = len(c.at)
    d1, d2 = np.square(x - c.at[first]).sum(1), np.square(x - c.at[second]).sum(1)
    swap = (d2 < d1) | ((d2 == d1) & (second < first))
    start = np.where(swap, second, first)
    best, best_d = start.copy(), np.minimum(d1, d2)
    next_, next_d = np.where(swap, first, second), np.maximum(d1, d2)
    if k == 1:
        return best, next_, best_d, np.full(len(x), np.iinfo(np.int64).max)
    other, from_start = next_.copy(), _distance(best_d) * (1 + SLACK)
    live = np.arange(len(x))
    for t in range(1, k):
        at = c.order[start[live], t]
        # beyond the ball: further than the second nearest, however it lies
        live, at = (part[c.apart[start[live], at] <= from_start[live] + _distance(next_d[live]) * (1 + SLACK)]
                    for part in (live, at))
        if not len(live):
            break
        new = at != other[live]
        rows, at = live[new], at[new]
        d = np.square(x[rows] - c.at[at]).sum(1)
        nearer = (d < best_d[rows]) | ((d == best_d[rows]) & (at < best[rows]))
        nextish = ~nearer & ((d < next_d[rows]) | ((d == next_d[rows]) & (at < next_[rows])))
        up, to = rows[nearer], at[nearer]
        next_[up], next_d[up] = best[up], best_d[up]
        best[up], best_d[up] = to, d[nearer]
        next_[rows[nextish]], next_d[rows[nextish]] = at[nextish], d[nextish]
    return best, next_, best_d, next_d


def _assigned(c: Centroids, last: bool):
    """One round of assignment over rows of the state; the first has no centroid yet."""
    others = c.furthest_other()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                n = batch.num_rows
                x = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)
                cluster, second, upper, lower, distance = (
                    batch[name].to_numpy(zero_copy_only=False).copy()
                    for name in ("cluster", "second", "upper", "lower", "distance"))
                known = cluster >= 0
                home = np.where(known, cluster, 0)
                upper = np.where(known, upper + c.moved[home], np.inf) * (1 + SLACK)
                lower = np.where(known, lower - others[home], 0) * (1 - SLACK)
                unsure = np.flatnonzero(~(upper < lower))
                # the exact distance may be enough where the bound was not
                exact = np.square(x[unsure] - c.at[home[unsure]]).sum(1)
                upper[unsure] = _distance(exact) * (1 + SLACK)
                distance[unsure] = exact
                unsure = unsure[~(upper[unsure] < lower[unsure])]
                hint = np.where(known[unsure], second[unsure], min(1, len(c.at) - 1))
                best, next_, best_d, next_d = search(x[unsure], c, home[unsure], hint)
                cluster, second = home, np.where(known, second, hint[0] if len(hint) else 0)
                cluster[unsure], second[unsure], distance[unsure] = best, next_, best_d
                upper[unsure], lower[unsure] = _distance(best_d) * (1 + SLACK), _distance(next_d) * (1 - SLACK)
                if last:
                    distance = np.square(x - c.at[cluster]).sum(1)
                yield pa.RecordBatch.from_pydict({
                    "row": batch["row"], "vec_id": batch["vec_id"], "vector": batch["vector"],
                    "cluster": pa.array(cluster, pa.int32()), "second": pa.array(second, pa.int32()),
                    "upper": pa.array(upper), "lower": pa.array(lower), "distance": pa.array(distance, pa.int64())})
    return assign


def cluster(df: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, components: int = 64, scale: int = 256,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia
    and centroid_sha256 (of the final centroid's components, joined by commas).

    Kept are vectors of exactly ``components`` components, none null or non-finite; each
    becomes floor(scale * component). A component of 2 ** 27 or more after that would take
    squared distances out of a long: such vectors are left out. Centroids start as the k
    vectors with the smallest sha256 of "seed:id"; rows without an id come last there, and
    of repeated ids the smaller vector first. With fewer than k vectors all of them start.
    Each round assigns every vector to its nearest centroid (ties: the smaller number) and
    moves every centroid that has vectors to the floor of their mean; a last assignment
    follows. Sums of distances beyond a long are null. Repeated rows count each. An empty table gives an empty result. Other columns
    of ``df`` are not read.

    Only k sums of vectors and the centroids pass through the driver, whatever the table.
    """
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda v: F.floor(v * float(scale)))
    fine = F.forall(F.col(vector_col).cast("array<double>"), lambda v: F.coalesce(
        F.abs(v) < float(LARGEST / scale), F.lit(False)))
    kept = df.where((F.size(vector_col) == components) & fine).select(
        F.col(id_col).cast("long").alias("vec_id"), scaled.cast("array<int>").alias("vector"))
    state = written(kept.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "vector", F.lit(-1).alias("cluster"),
        F.lit(-1).alias("second"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"),
        F.lit(0).cast("long").alias("distance")), "cluster-state")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = state.orderBy(name.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    if not start:
        return df.sparkSession.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    at, before = np.array([r.vector for r in start], np.int64), None
    for step in range(rounds + 1):
        last = step == rounds
        state = written(state.mapInArrow(_assigned(Centroids.of(at, before), last), STATE), "cluster-state")
        if not last:
            before, at = at, _means(state, at, components)
    # at most one row for each of the k centroids, here and back
    sums = dict(state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    whole = sum(map(int, sums.values()))
    facts = [(i, _long(int(sums[i])), _long(whole), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
             for i, c in enumerate(at.tolist()) if i in sums]
    facts = df.sparkSession.createDataFrame(
        facts, "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(facts), F.col("cluster") == F.col("c")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None


def _means(state: DataFrame, at: np.ndarray, components: int) -> np.ndarray:
    """Centroids moved to the floor of their vectors' mean; sums have a map-side combine."""
    sums = state.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("vector")[i]).alias(f"s{i}") for i in range(components)])
    out = at.copy()
    for r in sums.collect():  # at most one row for each centroid
        out[r[0]] = [s // r[1] for s in r[2:]]
    return out
