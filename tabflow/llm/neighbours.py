"""Near-duplicate vectors by NN-descent.

A graph of near neighbours is refined by the join of neighbours of neighbours: in each round every vector brings its
neighbours, and those it is a neighbour of, together, and each of them keeps the nearest it has met. The first graph links
vectors that are close in orders by random hyperplanes. All pairs met at or above the threshold are kept as edges.

A list whose neighbours all reach the threshold is saturated: it may have no room for the rest. The lists of linked vectors
are therefore enlarged to their whole component of the edges, which is compared in tiles, so that the number of links is
exact within it, and edges that the lists had no room for cannot be missed. An audit then holds the links of a sample of
vectors against brute force over all vectors. Every group of linked vectors counts as one there, whatever its size, and the
sample grows until enough groups are seen. Below the wanted recall the descent goes on, with more orders and longer lists;
after some audits, or where so few vectors are linked that the sample takes in all of them, brute force is the result.

Equal vectors are one class, and cosines are computed in double precision from unit vectors.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabflow.llm.common import drop_table, materialise, materialise_at
from tabflow.llm.components import components
from tabflow.session import shuffle_partitions

THRESHOLD = 0.95
#: Neighbours a vector keeps, orders of the first graph for up to a thousand vectors (two more whenever they double) and at
#: a time, the next ones taken in each, rounds between audits.
LIST, ORDERS, NEXT, ROUNDS = 8, 8, 4, 2
#: Vectors audited at first (by a hash of the id), the recall of their links that is wanted, audits before brute force.
AUDIT, RECALL, AUDITS = 500, 0.99, 4
#: Groups of linked vectors that an audit must see, and AUDITs of vectors that are compared with all others at a time.
GROUPS, BLOCK = 100, 16
#: Vectors of a component that are compared with as many others in one task.
TILE = 2000
SEED = 7


def _valid(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def _matrix(column) -> np.ndarray:
    """Unit rows in double precision of a list column whose lists are of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    m = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    m = m / np.abs(m).max(axis=1, keepdims=True)  # so that squares of tiny or huge numbers stay finite
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _pairs(a: list, b: list, sim: list):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b)), pa.array(np.concatenate(sim))], names=["id", "near", "sim"])


def _groups(batches, keys: list[str]):
    """Whole groups of rows that come sorted by the keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        v = np.stack([np.asarray(batch.column(k)) for k in keys], 1)
        cuts = [0, *(np.flatnonzero((v[1:] != v[:-1]).any(axis=1)) + 1).tolist(), len(v)]
        for a, b in zip(cuts, cuts[1:]):
            if held and [held[-1].column(k)[0].as_py() for k in keys] != v[a].tolist():
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _first_graph(vectors: DataFrame, dims: str, orders: range) -> DataFrame:
    """id, near, sim: each vector with the next ones in several orders by signs of random projections."""
    def sign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column("v"))
            for r in orders:
                bits = m @ np.random.default_rng([SEED, r]).standard_normal((m.shape[1], 30)) > 0
                key = bits @ (1 << np.arange(29, -1, -1))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), r, np.int32)), pa.array(key.astype(np.int64)), batch.column("id"), batch.column("v")], names=["r", "key", "id", "v"])

    def follow(batches):
        for batch in batches:  # pairs across batches are left to the other orders
            if batch.num_rows < 2:
                continue
            m, ids, r = _matrix(batch.column("v")), np.asarray(batch.column("id")), np.asarray(batch.column("r"))
            a, b, s = [], [], []
            for k in range(1, min(NEXT, len(ids) - 1) + 1):
                same = r[k:] == r[:-k]
                sim = np.einsum("ij,ij->i", m[k:], m[:-k])[same]
                x, y = ids[k:][same], ids[:-k][same]
                a += [x, y]
                b += [y, x]
                s += [sim, sim]
            yield _pairs(a, b, s)

    n = shuffle_partitions(vectors.sparkSession)
    signed = vectors.mapInArrow(sign, f"r int, key long, id long, v {dims}")
    return signed.repartitionByRange(n, "r", "key", F.xxhash64("id")).sortWithinPartitions("r", "key").mapInArrow(follow, "id long, near long, sim double")


def _nearest(met: DataFrame, k: int) -> DataFrame:
    """The k nearest of each vector among the pairs it has met."""
    once = met.groupBy("id", "near").agg(F.max("sim").alias("sim"))
    order = Window.partitionBy("id").orderBy(F.desc("sim"), "near")
    return once.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= k).drop("_k")


def _round(vectors: DataFrame, graph: DataFrame, k: int, threshold: float, dims: str, turn: int) -> DataFrame:
    """One join of neighbours of neighbours: pairs met that are nearer than a vector's list, or reach the threshold. Of
    those it is a neighbour of, a vector brings k, others each time, so that hubs stay bounded."""
    order = Window.partitionBy("near").orderBy(F.xxhash64("id", "near", F.lit(turn)))
    back = graph.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= k).select(F.col("near").alias("id"), F.col("id").alias("near"))
    around = graph.select("id", "near").unionByName(back).distinct()
    own = graph.select("id").distinct().withColumn("near", F.col("id"))
    last = graph.groupBy("id").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(-2.0).alias("last"))
    brought = around.unionByName(own).join(vectors.join(last, "id").select(F.col("id").alias("near"), "v", "last"), "near").select("id", "near", "v", "last")

    def meet(batches):
        a, b, s, n = [], [], [], 0
        for t in _groups(batches, ["id"]):
            m, ids, floor = _matrix(t.column("v")), np.asarray(t.column("near")), np.asarray(t.column("last"))
            sim = m @ m.T
            np.fill_diagonal(sim, -3)
            x, y = np.nonzero((sim > floor[:, None]) | (sim >= threshold))
            if len(x):
                a.append(ids[x])
                b.append(ids[y])
                s.append(sim[x, y])
                n += len(x)
            if n > 50_000:
                yield _pairs(a, b, s)
                a, b, s, n = [], [], [], 0
        if a:
            yield _pairs(a, b, s)

    parts = shuffle_partitions(vectors.sparkSession)
    return brought.repartition(parts, "id").sortWithinPartitions("id").mapInArrow(meet, "id long, near long, sim double").groupBy("id", "near").agg(F.max("sim").alias("sim"))


def _links_within(spark: SparkSession, vectors: DataFrame, membership: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """id, links (vectors at or above the threshold in the own component, with their numbers, itself included), by tiles of
    the component: no pair is emitted."""
    sizes = membership.groupBy("component").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts"))
    rows = membership.join(sizes, "component").join(vectors, "id").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    left = rows.select("component", F.col("part").alias("i"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"), F.lit(0).alias("side"), "id", "weight", "v")
    right = rows.select("component", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"), F.col("part").alias("j"), F.lit(1).alias("side"), "id", "weight", "v")
    tiles = left.unionByName(right).withColumn("tile", F.xxhash64("component", "i", "j"))

    def count(batches):
        for t in _groups(batches, ["component", "i", "j"]):
            side, m, weight, ids = (np.asarray(t.column("side")), _matrix(t.column("v")), np.asarray(t.column("weight"), np.int64), np.asarray(t.column("id")))
            mine, theirs = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            n = np.zeros(len(mine), np.int64)
            for k in range(0, len(mine), 500):
                n[k : k + 500] = (m[mine[k : k + 500]] @ m[theirs].T >= threshold) @ weight[theirs]
            yield pa.RecordBatch.from_arrays([pa.array(ids[mine]), pa.array(n)], names=["id", "links"])

    n = shuffle_partitions(spark)
    counted = tiles.repartition(n, "tile").sortWithinPartitions("component", "i", "j").mapInArrow(count, "id long, links long")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def _against(vectors: DataFrame, chosen: pa.Table, threshold: float) -> DataFrame:
    """Brute force of the chosen ones over all vectors: rows (id, links, classes) with what a task has found for each, and
    rows (a, b) of different components that a link joins, no more in a task than make them one."""
    ids, own, queries = np.asarray(chosen.column("id")), np.asarray(chosen.column("component")), _matrix(chosen.column("v"))

    def brute(batches):
        links, classes, root = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), {}

        def find(x):
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        a, b = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            m, weight, component = _matrix(batch.column("v")), np.asarray(batch.column("weight"), np.int64), np.asarray(batch.column("component"))
            for k in range(0, len(ids), 500):
                x, y = np.nonzero(queries[k : k + 500] @ m.T >= threshold)
                x += k
                links += np.bincount(x, weight[y], len(ids)).astype(np.int64)
                classes += np.bincount(x, minlength=len(ids))
                across = own[x] != component[y]
                if across.any():
                    for i, j in np.unique(np.stack([own[x][across], component[y][across]], 1), axis=0).tolist():
                        p, q = find(i), find(j)
                        if p != q:
                            root[max(p, q)] = min(p, q)
                            a.append(i)
                            b.append(j)
        none, nothing = [None] * len(ids), [None] * len(a)
        yield pa.RecordBatch.from_arrays([pa.array([*ids.tolist(), *nothing], pa.int64()), pa.array([*links.tolist(), *nothing], pa.int64()), pa.array([*classes.tolist(), *nothing], pa.int64()), pa.array([*none, *a], pa.int64()), pa.array([*none, *b], pa.int64())], names=["id", "links", "classes", "a", "b"])

    return vectors.select("v", "weight", "component").mapInArrow(brute, "id long, links long, classes long, a long, b long")


def _audit(vectors: DataFrame, links: DataFrame, n: int, threshold: float, whole: bool = False) -> tuple[float, DataFrame | None, DataFrame]:
    """Of n vectors (id, v, weight, component): the recall of the audited vectors' links, a group of linked vectors counting
    as one; the links of all vectors if all were audited, as they are where ``whole``; and the edges (id, near, sim) between
    components that the audit has met."""
    spark = vectors.sparkSession
    buckets = max(1, n // AUDIT)
    placed, path = materialise_at(spark, vectors.withColumn("bucket", F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(buckets))), "audited")
    parts, done, groups, hits = [], 0, 0.0, 0.0
    while done < buckets and (whole or groups < GROUPS):
        step = BLOCK if whole else min(max(1, done), BLOCK)
        chosen = placed.where((F.col("bucket") >= done) & (F.col("bucket") < done + step)).select("id", "v", "component").toArrow()
        done += step
        if not chosen.num_rows:
            continue
        parts.append(materialise(spark, _against(placed, chosen, threshold), "brute"))
        if not whole:
            true = parts[-1].where("id is not null").groupBy("id").agg(F.sum("links").alias("true"), F.sum("classes").alias("classes")).where("classes > 1")
            both = true.join(vectors.select("id", "weight"), "id").join(links, "id", "left")
            share = (F.coalesce("links", "weight") - F.col("weight")) / (F.col("true") - F.col("weight"))
            seen = both.agg(F.sum(1 / F.col("classes")), F.sum(share / F.col("classes"))).first()
            groups, hits = groups + (seen[0] or 0), hits + (seen[1] or 0)
    drop_table(spark, path)
    every = reduce(DataFrame.unionByName, parts)
    counted = every.where("id is not null").groupBy("id").agg(F.sum("links").alias("links")) if done >= buckets else None
    met = every.where("id is null").select(F.col("a").alias("id"), F.col("b").alias("near"), F.lit(1.0).alias("sim"))
    return hits / groups if groups else 1.0, counted, met


def near_duplicates(spark: SparkSession, table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of table (vec_id, embedding).

    Null, empty and zero vectors and those with null or non-finite components are linked with nothing; vectors of different
    lengths are compared within their length only. Rows that repeat a vec_id count as vectors of their own; a null vec_id
    is a component's smallest only if all its ids are null. An empty table gives an empty result; other columns are ignored.
    """
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).withColumn("ok", _valid(F.col("v")))
    dims = rows.schema["v"].dataType.simpleString()
    classes = rows.where("ok").groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("weight"))
    classes = materialise(spark, classes.withColumn("id", F.monotonically_increasing_id()), "vectors")
    found = None
    for (size,) in classes.select(F.size("v")).distinct().collect():  # lengths, in practice one
        part = _descend(spark, classes.where(F.size("v") == size), threshold, dims)
        found = part if found is None else found.unionByName(part)
    out = rows.join(classes.select("v", "id"), "v", "left") if found is not None else rows.withColumn("id", F.lit(None).cast("long"))
    if found is not None:
        out = out.where("ok").select("vec_id", "id").join(found, "id").select("vec_id", "links", "component")
        smallest = found.join(classes.select("id", "first"), "id").groupBy("component").agg(F.min("first").alias("component_id"))
        out = out.join(smallest, "component").select("vec_id", (F.col("links") - 1).alias("n_links"), "component_id")
        out = out.unionByName(rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    else:
        out = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _descend(spark: SparkSession, classes: DataFrame, threshold: float, dims: str) -> DataFrame:
    """id, links, component of the classes (id, v, weight) of one length."""
    vectors = classes.select("id", "v", "weight")
    plain = vectors.select("id", "v")
    n = vectors.count()
    more = ORDERS + math.ceil(2 * math.log2(max(1, n / 1000)))

    def linked() -> tuple[DataFrame, DataFrame]:
        every = reduce(DataFrame.unionByName, edges)
        stars = components(spark, every.select(F.col("id").alias("a"), F.col("near").alias("b")).where("a != b"))
        membership = materialise(spark, stars.select(F.col("node").alias("id"), "component"), "membership")
        return membership, vectors.join(membership, "id", "left").withColumn("component", F.coalesce("component", "id"))

    k, orders, turn, graph, edges = LIST, 0, 0, None, []
    for audit in range(AUDITS + 1):
        whole = audit == AUDITS
        if not whole:
            for first in range(orders, orders + more, ORDERS):
                met = materialise(spark, _first_graph(plain, dims, range(first, min(first + ORDERS, orders + more))), "met")
                edges.append(met.where(F.col("sim") >= threshold))
                graph = materialise(spark, _nearest(met if graph is None else graph.unionByName(met), k), "graph")
            orders += more
            for _ in range(ROUNDS):
                turn += 1
                met = materialise(spark, _round(plain, graph, k, threshold, dims, turn), "met")
                edges.append(met.where(F.col("sim") >= threshold))
                graph = materialise(spark, _nearest(graph.unionByName(met), k), "graph")
            membership, placed = linked()
            links = materialise(spark, _links_within(spark, vectors, membership, threshold), "links")
        recall, counted, missed = _audit(placed, links, n, threshold, whole)
        edges.append(missed)
        if counted is not None or recall >= RECALL:
            if not missed.isEmpty():
                membership, _ = linked()
                if counted is None:
                    links = materialise(spark, _links_within(spark, vectors, membership, threshold), "links")
            links = links if counted is None else counted
            break
        k *= 2
    return vectors.select("id", "weight").join(membership, "id", "left").join(links, "id", "left").select(
        "id", F.coalesce("links", "weight").alias("links"), F.coalesce("component", "id").alias("component"))
