"""Compression of vectors to codes: product codebooks learned by Lloyd's rounds over two trees, in integers.

Vectors are cut into blocks once, and each of a block's part positions gets a tree: nodes halve their points along the
widest component and hold the box around them, their sum and their number. In each round every position's entries get a tree
too, and pairs of nodes are met from the roots down. For a pair, the boxes bound the squared distance of any point to any
entry from both sides; an entry node that lies farther from a node of parts than some other entry node at its farthest is
dropped. Where one entry is left, the node's cached sum and number go to it whole; what is still open at the leaves is
compared point by point. Boxes, bounds and distances are integers, so ties, which go to the lower entry, are exact.

A round is one pass over the blocks, which are never rewritten; the codebooks' sums (entries x components of a vector) reach
the driver, and the codebooks go back with the tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm import blocks
from tabflow.llm.common import drop_table, materialise, ship

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Points of a leaf.
LEAF = 16
#: Labels whose sums are broadcast; more are joined by a shuffle, to the same result.
BROADCAST_ROWS = 1_000_000


class Tree:
    """A balanced tree over integer points: level L has 2^L nodes, whose points lie between edges[L] in order."""

    def __init__(self, points: np.ndarray, leaf: int, order: np.ndarray | None = None):
        n = len(points)
        self.depth = max(0, int(np.ceil(np.log2(n / leaf)))) if leaf > 1 else int(np.log2(n))
        self.edges = [(np.arange(2**level + 1) * n) >> level for level in range(self.depth + 1)]
        if order is None:
            order = np.arange(n)
            for edge in self.edges[:-1]:
                p, node = points[order], np.repeat(np.arange(len(edge) - 1), np.diff(edge))
                wide = np.argmax(np.maximum.reduceat(p, edge[:-1]) - np.minimum.reduceat(p, edge[:-1]), axis=1)
                order = order[np.lexsort((p[np.arange(n), wide[node]], node))]
        self.order, self.points = order, points[order]
        self.low = [np.minimum.reduceat(self.points, e[:-1]) for e in self.edges]
        self.high = [np.maximum.reduceat(self.points, e[:-1]) for e in self.edges]

    def sums(self) -> list[np.ndarray]:
        return [np.add.reduceat(self.points, e[:-1]) for e in self.edges]


def _bounds(low: np.ndarray, high: np.ndarray, e_low: np.ndarray, e_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest squared distance between points of two boxes, pair by pair."""
    gap = np.maximum(np.maximum(e_low - high, low - e_high), 0)
    far = np.maximum(e_high - low, high - e_low)
    return np.einsum("ij,ij->i", gap, gap), np.einsum("ij,ij->i", far, far)


def _spread(edge: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For nodes with points between edges: the pair each point belongs to, and the point."""
    n = edge[nodes + 1] - edge[nodes]
    return np.repeat(np.arange(len(nodes)), n), np.repeat(edge[nodes] - np.cumsum(n) + n, n) + np.arange(n.sum())


def dual_assign(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]], int]:
    """The nearest entry of each point in the tree's order (ties to the lower one); the nodes that were assigned whole, as
    (level, nodes, entries); and the number of point distances computed."""
    other, code, whole = Tree(entries, 1), np.full(len(tree.points), -1), []
    level, e_level = 0, 0  # the entries themselves come after the last level of their tree
    node, e_node = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(node):
        if e_level <= other.depth:
            e_low, e_high = other.low[e_level][e_node], other.high[e_level][e_node]
        else:
            e_low = e_high = entries[e_node]
        least, most = _bounds(tree.low[level][node], tree.high[level][node], e_low, e_high)
        start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        within = np.repeat(np.minimum.reduceat(most, start), np.diff(np.r_[start, len(node)]))
        node, e_node = node[least <= within], e_node[least <= within]
        if e_level > other.depth:
            start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            alone = np.diff(np.r_[start, len(node)]) == 1
            done = start[alone]
            whole.append((level, node[done], e_node[done]))
            of, point = _spread(tree.edges[level], node[done])
            code[point] = e_node[done][of]
            keep = np.ones(len(node), bool)
            keep[done] = False
            node, e_node = node[keep], e_node[keep]
            if level == tree.depth:
                break
        # one level down in both trees
        if level < tree.depth:
            pair = np.stack([2 * node, 2 * node + 1], 1).ravel()
            node, e_node, level = pair, np.repeat(e_node, 2), level + 1
        if e_level < other.depth:
            node, e_node, e_level = np.repeat(node, 2), np.stack([2 * e_node, 2 * e_node + 1], 1).ravel(), e_level + 1
        elif e_level == other.depth:
            of, point = _spread(other.edges[other.depth], e_node)
            node, e_node, e_level = node[of], other.order[point], e_level + 1
        by = np.lexsort((e_node, node))
        node, e_node = node[by], e_node[by]
    of, point = _spread(tree.edges[level], node) if len(node) else (np.empty(0, np.int64),) * 2
    entry = e_node[of]
    gap = tree.points[point] - entries[entry]
    distance = np.einsum("ij,ij->i", gap, gap)
    by = np.lexsort((entry, distance, point))
    first = by[np.r_[True, point[by][1:] != point[by][:-1]]] if len(by) else by
    code[point[first]] = entry[first]
    return code, whole, len(point)


def _plant(parts: int):
    """The orders of a block's trees, one for each part position."""
    def plant(x: np.ndarray) -> dict:
        orders = [Tree(p, LEAF).order.astype(np.int32) for p in np.split(x, parts, axis=1)]
        return {"orders": np.concatenate(orders).tobytes()}

    return plant


def _trees(row: dict, size: int, parts: int) -> list[Tree]:
    x = blocks.matrix(row["x"], size)
    orders = np.frombuffer(row["orders"], np.int32).reshape(parts, len(x))
    return [Tree(p, LEAF, order) for p, order in zip(np.split(x, parts, axis=1), orders)]


def _round(size: int, parts: int, books: np.ndarray):
    """A task's sums and numbers of the parts that each entry is nearest to; books is parts x entries x components."""
    def add(batches):
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                for p, tree in enumerate(_trees(row, size, parts)):
                    code, whole, _ = dual_assign(tree, books[p])
                    cached, left = tree.sums(), np.ones(len(code), bool)
                    for level, nodes, entry in whole:
                        np.add.at(sums[p], entry, cached[level][nodes])
                        np.add.at(counts[p], entry, np.diff(tree.edges[level])[nodes])
                        left[_spread(tree.edges[level], nodes)[1]] = False
                    np.add.at(sums[p], code[left], tree.points[left])
                    np.add.at(counts[p], code[left], 1)
        yield blocks.partial(sums, counts)

    return add


def _encode(size: int, parts: int, books: np.ndarray):
    def encode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes, error = [], 0
                for p, tree in enumerate(_trees(row, size, parts)):
                    found = dual_assign(tree, books[p])[0]
                    gap, code = tree.points - books[p][found], np.empty(len(found), np.uint8)
                    code[tree.order] = found
                    own = np.empty(len(found), np.int64)
                    own[tree.order] = np.einsum("ij,ij->i", gap, gap)
                    codes.append(code)
                    error = error + own
                text = np.stack(codes, 1).tobytes().hex()
                yield pa.RecordBatch.from_arrays([pa.array(row["vec_id"], pa.int64()), pa.array(row["label"], pa.int64()), pa.array([text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return encode


def learn(spark: SparkSession, table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept vector of table (vec_id, embedding, label), written, and the codebooks
    (parts x entries x components).

    Kept are vectors without null or non-finite components, as integers floor(scale * x), that have as many components as
    the kept one with the smallest vec_id; that number must be a positive multiple of parts, or there is no result. Each
    position's codebook starts with the parts of the vectors with the smallest vec_ids (rows that repeat one ordered by their
    components, null ids last); with fewer vectors there are fewer entries. An empty table gives an empty result; columns
    other than these are ignored.
    """
    ship(spark)
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("v"))
    kept = rows.where(blocks.finite(F.col("v")))
    by = (F.col("vec_id").asc_nulls_last(), F.col("v"))
    first = kept.select("vec_id", "v").orderBy(*by).limit(1).collect()
    empty = "vec_id long, label long, code string, error long"
    size = len(first[0]["v"]) if first else 0
    if not size or size % parts:
        return spark.createDataFrame([], empty), np.empty((parts, 0, 0), np.int64)
    kept = kept.where(F.size("v") == size)
    heads = kept.select("vec_id", "v").orderBy(*by).limit(entries).collect()
    cut, path = blocks.cut(spark, kept, "vec_id long, label long", size, scale, "parts", ", orders binary", _plant(parts))
    books = np.stack([blocks.integers(r["v"], scale) for r in heads]).reshape(len(heads), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = blocks.means(cut.select("x", "orders").mapInArrow(_round(size, parts, books), blocks.PARTIAL), books.shape, books)
    found = materialise(spark, cut.mapInArrow(_encode(size, parts, books), empty), "codes")
    drop_table(spark, path)
    return found, books


def vector_codes(spark: SparkSession, table: DataFrame, **settings) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept vector; settings as for learn."""
    found, books = learn(spark, table, **settings)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    labels = materialise(spark, found.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")), "labels")
    if labels.count() <= BROADCAST_ROWS:
        labels = F.broadcast(labels)
    out = found.join(labels, found["label"].eqNullSafe(labels["_label"]))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
