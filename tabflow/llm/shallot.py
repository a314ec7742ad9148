"""Exact centroid clustering in integers with Shallot's search.

Vectors are cut into blocks once. A block keeps, for each vector, its centroid, the centroid that was second nearest, a bound
from above on the distance to the first and a bound from below on the distance to all others. In each round

* the bounds are widened by how far the centroids moved; a vector whose upper bound is below its lower bound, or below half
  the distance from its centroid to the nearest other one, keeps its centroid;
* for the rest the distances to both remembered centroids are computed, and the search starts from the closer one: the other
  centroids are met in ascending distance from it, until that distance is beyond the vector's distance from the start plus
  the second smallest distance found so far. This ball shrinks as nearer centroids are found; those within it are compared
  by squared distances in integers, ties going to the smaller number.

Bounds are floating-point numbers and are only trusted with a margin; all that they leave open is decided by integers, so
the result is that of comparing every vector with every centroid. A round is one pass over the blocks, which writes the
new state and the block's sums; the centroids' sums, k x size numbers, reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm import blocks
from tabflow.llm.common import drop_table, materialise, materialise_at, ship

SIZE, CENTROIDS, ROUNDS, SCALE, SALT = 64, 40, 5, 256, "2"
#: Bounds must differ by this share to be trusted; far above the rounding of some hundred additions.
MARGIN = 1e-9
#: Centroid components that the driver and each task hold at most.
MOST = 8_000_000
_STATE = ", a binary, b binary, u binary, l binary, sums binary, counts binary"


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("ij,ij->i", d, d)


class Ring:
    """The centroids of a round, with all others of each in ascending distance."""

    def __init__(self, centroids: np.ndarray, moved: np.ndarray | None = None):
        self.c, k = centroids, len(centroids)
        between = np.sqrt(np.stack([_squared(centroids, np.broadcast_to(c, centroids.shape)) for c in centroids]).astype(np.float64))
        np.fill_diagonal(between, -1.0)
        self.order = np.argsort(between, axis=1, kind="stable")[:, 1:]
        self.reach = np.take_along_axis(between, self.order, axis=1)
        self.half = self.reach[:, 0] / 2 if k > 1 else np.full(k, np.inf)
        self.drift = np.zeros(k) if moved is None else np.sqrt(moved.astype(np.float64)) * (1 + MARGIN)
        # how far any other centroid than each one moved
        top = np.sort(self.drift)[::-1]
        self.others = np.where(self.drift == top[0], top[1] if k > 1 else 0.0, top[0]) if (self.drift == top[0]).sum() == 1 else np.full(k, top[0])

    def assign(self, x: np.ndarray, a: np.ndarray, b: np.ndarray, u: np.ndarray, low: np.ndarray) -> int:
        """Move a, b, u, low to the new round, in place; returns the number of distances computed."""
        k, met = len(self.c), 0
        u += self.drift[a]
        low -= self.others[a]
        if k == 1:
            a[:] = b[:] = 0
            return 0
        sure = np.maximum(low, self.half[a]) * (1 - MARGIN)
        rest = np.flatnonzero(~(u < sure))
        first = _squared(x[rest], self.c[a[rest]])
        met += len(rest)
        u[rest] = np.sqrt(first.astype(np.float64))
        open_ = ~(u[rest] < sure[rest])
        rest, first = rest[open_], first[open_]
        if not len(rest):
            return met
        best, second = a[rest].astype(np.int64), b[rest].astype(np.int64)
        then = _squared(x[rest], self.c[second])
        met += len(rest)
        swap = (then < first) | ((then == first) & (second < best))
        best[swap], second[swap] = second[swap], best[swap]
        first[swap], then[swap] = then[swap], first[swap]
        start, other, from_start = best.copy(), second.copy(), np.sqrt(first.astype(np.float64))
        live = np.arange(len(rest))
        for t in range(k - 1):
            ball = (from_start[live] + np.sqrt(then[live].astype(np.float64))) * (1 + MARGIN)
            live = live[self.reach[start[live], t] <= ball]
            if not len(live):
                break
            j = self.order[start[live], t]
            new = j != other[live]
            at, j = live[new], j[new]
            d = _squared(x[rest[at]], self.c[j])
            met += len(at)
            front = (d < first[at]) | ((d == first[at]) & (j < best[at]))
            behind = ~front & (d < then[at])
            f = at[front]
            then[f], second[f] = first[f], best[f]
            first[f], best[f] = d[front], j[front]
            s = at[behind]
            then[s], second[s] = d[behind], j[behind]
        a[rest], b[rest] = best, second
        u[rest] = np.sqrt(first.astype(np.float64)) * (1 + MARGIN)
        low[rest] = np.sqrt(then.astype(np.float64)) * (1 - MARGIN)
        return met


def _step(size: int, ring: Ring, last: bool):
    """One round over blocks: the new state with the block's sums or, in the last one, a row per vector."""
    k = len(ring.c)

    def step(batches):
        for batch in batches:
            for row in batch.to_pylist():
                x = blocks.matrix(row["x"], size)
                a, b = (np.frombuffer(row[c], np.int32).copy() for c in "ab")
                u, low = (np.frombuffer(row[c], np.float64).copy() for c in "ul")
                ring.assign(x, a, b, u, low)
                if last:
                    yield pa.RecordBatch.from_arrays([pa.array(row["vec_id"], pa.int64()), pa.array(a, pa.int32()), pa.array(_squared(x, ring.c[a]), pa.int64())], names=["vec_id", "cluster", "distance"])
                    continue
                sums, by = np.zeros((k, size), np.int64), np.argsort(a, kind="stable")
                some, at = np.unique(a[by], return_index=True)
                sums[some] = np.add.reduceat(x[by], at)
                new = {"a": a, "b": b, "u": u, "l": low, "sums": sums, "counts": np.bincount(a, minlength=k).astype(np.int64)}
                yield pa.RecordBatch.from_arrays([pa.array([row["vec_id"]], pa.list_(pa.int64())), pa.array([row["x"]], pa.binary()), *[pa.array([v.tobytes()], pa.binary()) for v in new.values()]], names=["vec_id", "x", *new])

    return step


def _summed(table: DataFrame, k: int, size: int) -> DataFrame:
    def add(batches):
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for s, n in zip(batch.column("sums").to_pylist(), batch.column("counts").to_pylist()):
                sums += np.frombuffer(s, np.int64).reshape(k, size)
                counts += np.frombuffer(n, np.int64)
        yield blocks.partial(sums, counts)

    return table.select("sums", "counts").mapInArrow(add, blocks.PARTIAL)


def cluster(spark: SparkSession, table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, salt: str = SALT) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector of table (vec_id, embedding), written, and the final centroids.

    Kept are vectors of ``size`` components, none null or non-finite, as integers floor(scale * x). The first centroids are
    the k kept vectors with the smallest sha256 of "salt:vec_id"; with fewer vectors there are fewer centroids. Rows that
    repeat a vec_id take part as vectors of their own, ordered by their components; a null vec_id is no centroid before all
    others. An empty table, or none kept, gives an empty result; other columns are ignored.
    """
    ship(spark)
    if k * size > MOST:
        raise ValueError(f"{k} centroids of {size} components: at most {MOST} numbers are held in one task")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    kept = rows.where((F.size("v") == size) & blocks.finite(F.col("v")))
    place = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    heads = kept.select(place.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    empty = "vec_id long, cluster int, distance long"
    if not heads:
        return spark.createDataFrame([], empty), np.empty((0, size), np.int64)
    k = len(heads)

    def begin(x):
        n, second = len(x), min(1, k - 1)
        state = (np.zeros(n, np.int32), np.full(n, second, np.int32), np.full(n, np.inf), np.zeros(n), np.empty(0), np.empty(0))
        return dict(zip(("a", "b", "u", "l", "sums", "counts"), (s.tobytes() for s in state)))

    state, path = blocks.cut(spark, kept, "vec_id long", size, scale, "vectors", _STATE, begin)
    centroids, moved = np.stack([blocks.integers(r["v"], scale) for r in heads]), None
    for _ in range(rounds):
        after, after_path = materialise_at(spark, state.mapInArrow(_step(size, Ring(centroids, moved), False), state.schema), "clustered")
        drop_table(spark, path)
        state, path = after, after_path
        new = blocks.means(_summed(state, k, size), centroids.shape, centroids)
        moved, centroids = _squared(new, centroids), new
    found = materialise(spark, state.mapInArrow(_step(size, Ring(centroids, moved), True), empty), "assigned")
    drop_table(spark, path)
    return found, centroids


def centroid_clusters(spark: SparkSession, table: DataFrame, **settings) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector; settings as for cluster."""
    found, centroids = cluster(spark, table, **settings)
    total = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame([(i, total.get(i, 0), sum(total.values()), d) for i, d in enumerate(digest)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # one row per centroid
