"""Exact Jaccard join of documents' word shingles, as a metric-space join.

1 - Jaccard is a metric. Documents are at distance 1 from all that share no shingle, so a few pivots would tell nothing
apart; regions are therefore made in three steps, each of which keeps every pair within the radius together:

* Single shingles as pivots. A document is at distance 1 - 1/n from each of its n shingles and at 1 from all others, so
  these are its nearest pivots. If ties go to the shingle that is first in a global order, frequent ones last, a partner
  within the radius shares one of a document's first n - ceil(t n) + 1 shingles: the window of regions it is copied to.
  Within a region, counts of shingles by parts of the hash space bound the distance from below: members that may be
  within the radius by that bound get an edge (large regions are cut along gaps in the distance from a pivot). The edges' connected components are
  families, and every pair within the radius is in one family.
* Documents as pivots, for families above FAMILY shingles. A document within the radius r of a pivot is linked to it, and
  belongs to the Voronoi cell of the nearest such pivot. A partner of a member of p's cell is within 2r of p: p's window. What is in no cell goes on, with new
  pivots, and recursively, until it is small. A cell is joined with the others of its window in blocks, and only members x with
  d(x, p) >= min d(y, p) - r over the others y of the window take part.
* The same in memory, for small families, with each document that is in no cell yet as the next pivot. Members x of p's cell
  are compared with the others if a pivot q that is not known to be linked to p has d(p, q) <= d(x, p) + 2r.

Links within a component that is already connected are not searched for, as only components are returned. Distances are
exact: they are computed from the whole sets of 64-bit shingle hashes.

Documents with equal sets are one class; a class's representative takes part, and its members get its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabflow.llm.common import drop_table, frugal, materialise, materialise_at, release_shuffles, slices
from tabflow.llm.components import components
from tabflow.session import shuffle_partitions

WORDS, PERCENT = 5, 75
#: Shingles of more documents than this are put last in the order, the more frequent the later.
FREQUENT = 16
#: Regions up to this many members are compared pair by pair; larger ones hold documents of mostly frequent shingles.
SMALL = 16
#: Members of a region that a task holds at a time.
HELD = 20_000
#: The list of frequent shingles is broadcast; beyond this many the bound above is doubled until the list is as short.
MAX_FREQUENT = 4_000_000
#: Shingles (summed over documents) of a family that is joined in one task's memory, and these times its documents.
FAMILY, WORK = 3_000_000, 20_000_000_000
#: Document pivots of a large family in the first round; each further round takes twice as many.
PIVOTS = 32
#: Members of a cell, and others of its window, that meet in one task.
CELL = 2000
#: Documents whose ids are broadcast to pick their texts from a scan; more are picked by a shuffle, to the same result.
BROADCAST_ROWS = 1_000_000
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]  # fixed values: odd multipliers


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD[1]
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text; A-Z count as a-z, words end at ASCII white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, parents = lists.flatten(), np.asarray(pc.list_parent_indices(lists))
    full = np.asarray(pc.not_equal(flat, ""))
    if not full.all():  # white space at an edge leaves an empty piece
        flat, parents = flat.filter(pa.array(full)), parents[full]
    n = np.bincount(parents, minlength=len(texts))
    coded = pc.dictionary_encode(flat)
    each = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
    w = each[np.asarray(coded.indices)] if len(flat) else np.empty(0, np.uint64)
    h = np.zeros(max(0, len(w) - words + 1), np.uint64)
    for k in range(words):
        h = _mix(h + w[k : k + len(h)] * _ODD[k % 5])
    out, at = [], 0
    for size in n.tolist():
        if size >= words:
            out.append(np.unique(h[at : at + size - words + 1]))
        elif size:
            one = np.full(1, size, np.uint64)
            for k in range(size):
                one = _mix(one * _ODD[4] + w[at + k : at + k + 1] * _ODD[k % 5])
            out.append(one)
        else:
            out.append(np.empty(0, np.uint64))
        at += size
    return out


def _allowed(n: int, percent: int) -> int:
    """How many of a document's first shingles a partner must share one of."""
    return n - -(-percent * n // 100) + 1


def _linked(common: np.ndarray, a: int | np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


# --- sets, classes, frequent shingles -------------------------------------------------------------------------------

_BUCKETS = 64
_PASS_SCHEMA = "_row long, n long, key binary, node long, counts binary, bucket int, hashes binary"
#: Parts that the space of hashes is cut into for counting a set's shingles in each: the first number that leaves some 8
#: shingles in a part, the last one for larger sets. Each divides the next, so counts can be folded.
PARTS = (64, 512, 4096)


def _counts(sets: list[np.ndarray]) -> list[bytes]:
    """How many of each set's hashes lie in each part, at most 255: sets differ in at least as many shingles as the sum of
    these counts' differences says."""
    out = []
    for s in sets:
        k = next((k for k in PARTS if len(s) <= 8 * k), PARTS[-1])
        out.append(np.minimum(np.bincount((s % np.uint64(k)).astype(np.int64), minlength=k), 255).astype(np.uint8).tobytes())
    return out


class _Counts:
    """Counts of many sets, by their number of parts and folded to fewer."""

    def __init__(self, column):
        raw = column.to_pylist()
        self.parts = np.array([len(x) for x in raw], np.int64)
        self.at: dict[int, np.ndarray] = {}  # parts: row of each set in the folded matrix, -1 if it has fewer parts
        self.folded: dict[int, np.ndarray] = {}
        for k in PARTS:
            own = np.flatnonzero(self.parts >= k)
            self.at[k] = np.full(len(raw), -1)
            self.at[k][own] = np.arange(len(own))
            rows = np.zeros((len(own), k), np.uint16)
            for size in np.unique(self.parts[own]).tolist():
                these = np.flatnonzero(self.parts[own] == size)
                m = np.frombuffer(b"".join(raw[i] for i in own[these]), np.uint8).reshape(len(these), -1, k)
                rows[these] = m.sum(axis=1, dtype=np.uint16)
            self.folded[k] = rows

    def from_pivot(self, sets: np.ndarray) -> np.ndarray:
        """A metric's distances of sets from the first of them: their counts' differences in one number of parts."""
        k = int(self.parts[sets].min())
        rows, out = self.at[k][sets], np.zeros(len(sets), np.int64)
        pivot = self.folded[k][rows[0]].astype(np.int32)
        for i in range(0, len(sets), 4096 * 64 // k):
            part = slice(i, i + 4096 * 64 // k)
            out[part] = np.abs(self.folded[k][rows[part]] - pivot).sum(axis=1)
        return out

    def differ(self, mine: np.ndarray, other: "_Counts", theirs: np.ndarray) -> np.ndarray:
        """For pairs of sets, at least how many shingles they differ in."""
        out = np.zeros(len(mine), np.int64)
        k_of = np.minimum(self.parts[mine], other.parts[theirs])
        for k in PARTS:
            own = np.flatnonzero(k_of == k)
            for i in range(0, len(own), 4096 * 64 // k):
                part = own[i : i + 4096 * 64 // k]
                a, b = self.folded[k][self.at[k][mine[part]]].astype(np.int32), other.folded[k][other.at[k][theirs[part]]]
                out[part] = np.abs(a - b).sum(axis=1)
        return out


def _node(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _may_link(differ: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of sizes a and b that differ in at least so many shingles may be linked."""
    return 100 * (a + b - differ) >= percent * (a + b + differ)


def _measure(rows: DataFrame, words: int) -> DataFrame:
    """A row per document with its set's size and 128-bit key, and rows with the 32-bit heads of a task's shingle hashes
    by bucket (compressed, sorted), for counting."""
    names = ["_row", "n", "key", "node", "counts", "bucket", "hashes"]

    def measure(batches):
        held: list[np.ndarray] = []

        def flush():
            if not held:
                return
            heads = np.sort(np.concatenate(held))
            held.clear()
            cut = np.searchsorted(heads, np.arange(_BUCKETS + 1, dtype=np.uint64) << np.uint64(26))
            packs = []
            for b in range(_BUCKETS):
                part = heads[cut[b] : cut[b + 1]]
                steps = np.diff(part, prepend=np.uint32(b << 26)).astype("<u4")
                packs.append(zstandard.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1))
            nulls = [None] * _BUCKETS
            yield pa.RecordBatch.from_arrays([pa.array(nulls, pa.int64()), pa.array(nulls, pa.int64()), pa.array(nulls, pa.binary()), pa.array(nulls, pa.int64()), pa.array(nulls, pa.binary()), pa.array(range(_BUCKETS), pa.int32()), pa.array(packs, pa.binary())], names=names)

        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), words)
            keys = [xxhash.xxh128_digest(s.tobytes()) for s in sets]
            nulls = [None] * len(sets)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array([_node(k) for k in keys], pa.int64()), pa.array(_counts(sets), pa.binary()), pa.array(nulls, pa.int32()), pa.array(nulls, pa.binary())], names=names)
            held += [(s >> np.uint64(32)).astype(np.uint32) for s in sets if len(s)]
            if sum(map(len, held)) > 8_000_000:
                yield from flush()
        yield from flush()

    return rows.mapInArrow(frugal(measure), _PASS_SCHEMA)


def _unpack(data: bytes, bucket: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    steps = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4")[:, 0]
    return (np.uint32(bucket << 26) + np.cumsum(steps, dtype=np.uint32)).astype(np.uint32)


def _frequent(measured: DataFrame, above: int) -> DataFrame:
    """head, n: 32-bit heads of shingle hashes in more than ``above`` documents. Each bucket is cut in 64 so that a group
    holds a 4096th of all heads."""
    fine = 64

    def cut(batches):
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("hashes").to_pylist()):
                heads = _unpack(data, bucket)
                edge = np.searchsorted(heads, (np.arange(fine + 1, dtype=np.uint64) << np.uint64(20)) + np.uint64(bucket << 26))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(fine, dtype=np.int32) + bucket * fine), pa.array([zstandard.compress(np.diff(heads[a:b], prepend=np.uint32(0)).astype("<u4").tobytes(), 1) for a, b in zip(edge, edge[1:])], pa.binary())], names=["b", "h"])

    def count(key, group):
        parts = [np.cumsum(np.frombuffer(zstandard.decompress(x), "<u4"), dtype=np.uint32) for x in group.column("h").to_pylist()]
        heads, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.table({"head": heads[n > above].astype(np.int64), "n": n[n > above].astype(np.int64)})

    packs = measured.where(F.col("bucket").isNotNull()).select("bucket", "hashes").mapInArrow(frugal(cut), "b int, h binary")
    return packs.groupBy("b").applyInArrow(count, "head long, n long")


# --- regions of single shingles, families ---------------------------------------------------------------------------


def _first_shingles(rows: DataFrame, frequent, words: int, percent: int) -> DataFrame:
    """sig, node: each document's first shingles in the global order."""
    def first(batches):
        heads, classes = frequent.value
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), words)
            sig, of = [], []
            flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            h = (flat >> np.uint64(32)).astype(np.uint32)
            at = np.minimum(np.searchsorted(heads, h), max(0, len(heads) - 1))
            cls = np.where(heads[at] == h, classes[at], 0) if len(heads) else np.zeros(len(flat), np.uint8)
            edge = np.cumsum([0, *map(len, sets)])
            for s, a, b in zip(sets, edge, edge[1:]):
                if not len(s):
                    continue
                k = _allowed(len(s), percent)
                c = cls[a:b]
                rare = s[c == 0]
                sig.append(rare[:k] if len(rare) >= k else s[np.argsort(c, kind="stable")[:k]])
                of.append(np.full(k, _node(xxhash.xxh128_digest(s.tobytes())), np.int64))
            if sig:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(of))], names=["sig", "node"])

    return rows.mapInArrow(frugal(first), "sig long, node long")


def _regions(members: DataFrame) -> DataFrame:
    """What is to be compared, from the members (sig, node) of all regions. kind 0: a pair (a, b) of a small region. kind 1:
    a member b of the larger region a. kind 2: a link (a, b) of a region that is too large to be held, which stands for its
    pairs and is not compared but taken into the families as it is."""
    def gather(batches):
        sig, node, tied = np.empty(0, np.int64), np.empty(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            s, r = np.concatenate([sig, np.asarray(batch.column("sig"))]), np.concatenate([node, np.asarray(batch.column("node"))])
            keep = np.ones(len(s), bool)
            keep[1:] = (s[1:] != s[:-1]) | (r[1:] != r[:-1])
            s, r = s[keep], r[keep]
            cut = int(np.searchsorted(s, s[-1]))  # the last region may go on
            yield from emit(s[:cut], r[:cut], tied)
            sig, node = s[cut:], r[cut:]
            if len(sig) > HELD:  # hand on what is there; the first member stays, and ties what follows
                tied = sig[0]
                yield from emit(sig, node, tied)
                sig, node = sig[:1], node[:1]
        yield from emit(sig, node, tied)

    def emit(s, r, tied):
        if len(s):
            start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
            size = np.diff(np.r_[start, len(s)])
            out = []
            for g in range(2, SMALL + 1):
                own = r[start[(size == g) & (s[start] != tied if tied is not None else True)][:, None] + np.arange(g)]
                i, j = np.triu_indices(g, 1)
                if len(own):
                    out.append(np.unique(np.stack([own[:, i].ravel(), own[:, j].ravel()], 1), axis=0))
            pairs = np.concatenate(out) if out else np.empty((0, 2), np.int64)
            large = np.repeat(size > SMALL, size)
            huge = s == tied if tied is not None else np.zeros(len(s), bool)
            heads = np.repeat(r[start], size)
            large &= ~huge
            a = np.concatenate([pairs[:, 0], s[large], heads[huge]])
            b = np.concatenate([pairs[:, 1], r[large], r[huge]])
            kind = np.repeat(np.array([0, 1, 2], np.int32), [len(pairs), large.sum(), huge.sum()])
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(kind)], names=["a", "b", "kind"])

    n = shuffle_partitions(members.sparkSession)
    return members.repartition(n, "sig").sortWithinPartitions("sig", "node").mapInArrow(frugal(gather), "a long, b long, kind int")


def _candidates(spark: SparkSession, regions: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """a, b: edges whose components hold every pair within the radius. Pairs and members of regions meet through the counts
    of their sets, which bound the distance from below: a metric of its own, whose cells need no exact distances."""
    facts = lambda c: classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("counts").alias(f"counts_{c}"))

    def near(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 2000):
                batch = whole.slice(i, 2000)
                every = np.arange(batch.num_rows)
                differ = _Counts(batch.column("counts_a")).differ(every, _Counts(batch.column("counts_b")), every)
                ok = _may_link(differ, np.asarray(batch.column("n_a")), np.asarray(batch.column("n_b")), percent)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok))

    def cells(batches):
        for t in _by_group(batches, "a"):
            counts, sizes, nodes = _Counts(t.column("counts_b")), np.asarray(t.column("n_b")), np.asarray(t.column("b"))
            free, out = np.arange(len(nodes)), []
            while len(free) > 1:
                # by distance from a pivot, in as many parts as all have: across a gap wider than any link, nothing is linked
                differ = counts.from_pivot(free)
                order = np.argsort(differ, kind="stable")
                room = 2 * int(sizes[free].max()) * (100 - percent) // (100 + percent)
                gaps = np.flatnonzero(np.diff(differ[order]) > room)
                cut = gaps[0] + 1 if len(gaps) else len(order)
                out += [(nodes[free[0]], x) for x in nodes[free[order[:cut]]] if x != nodes[free[0]]]
                free = free[np.sort(order[cut:])]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    pairs = regions.where("kind = 0").select("a", "b").distinct()
    small = pairs.join(facts("a"), "a").join(facts("b"), "b").select("a", "b", "n_a", "n_b", "counts_a", "counts_b").mapInArrow(frugal(near), "a long, b long")
    n = shuffle_partitions(spark)
    members = regions.where("kind = 1").select("a", "b").join(facts("b"), "b")
    large = members.select("a", "b", "n_b", "counts_b").repartition(n, "a").sortWithinPartitions("a", "b").mapInArrow(frugal(cells), "a long, b long")
    return small.unionByName(large).unionByName(regions.where("kind = 2").select("a", "b")).where("a <> b").distinct()


# --- joins of document sets -----------------------------------------------------------------------------------------


class _Index:
    """Sets of a family, by shingle."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.sizes = sets, np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], owner[order]

    def common(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sets that share a shingle with s, and how many they share."""
        a, b = np.searchsorted(self.flat, s, "left"), np.searchsorted(self.flat, s, "right")
        n = b - a
        hit = self.owner[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]
        count = np.bincount(hit, minlength=len(self.sets))
        which = np.flatnonzero(count)
        return which, count[which]


class _Family:
    """Sets of a family, for counting what some of them share with all. Shingles that the same sets have count as one, with
    a weight, and shingles of many sets are rows of a matrix."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes, g = np.array([len(s) for s in sets], np.int64), len(sets)
        flat, owner = np.concatenate(sets), np.repeat(np.arange(g), self.sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        n = np.diff(np.r_[start, len(flat)])
        # equal lists of sets have equal sums of 128 random bits
        marks = np.random.default_rng(0).integers(0, 2**63, (2, g), np.uint64)
        sums = [np.add.reduceat(m[owner], start) for m in marks]
        by = np.lexsort(sums)
        new = np.r_[True, (sums[0][by][1:] != sums[0][by][:-1]) | (sums[1][by][1:] != sums[1][by][:-1])]
        first, weight = by[new], np.diff(np.r_[np.flatnonzero(new), len(by)])
        many = n[first] > 1  # what one set alone has is shared with none
        first, weight = first[many], weight[many]
        start, n = start[first], n[first]
        heavy = n > max(32, g // 8)
        self.matrix = np.zeros((int(heavy.sum()), g), np.float32)
        row = np.repeat(np.arange(len(self.matrix)), n[heavy])
        self.matrix[row, owner[_ranges(start[heavy], n[heavy])]] = 1
        self.heavy = weight[heavy].astype(np.float32)
        # the others: sets by shingle, and shingles by set
        start, self.n, self.weight = start[~heavy], n[~heavy], weight[~heavy].astype(np.float64)
        self.sets = owner[_ranges(start, self.n)]
        self.begin = np.cumsum(self.n) - self.n
        shingle = np.repeat(np.arange(len(self.n)), self.n)
        order = np.argsort(self.sets, kind="stable")
        self.shingles, self.edge = shingle[order], np.searchsorted(self.sets[order], np.arange(g + 1))

    def common(self, rows: np.ndarray) -> np.ndarray:
        """How many shingles each of the sets named shares with every set."""
        g = len(self.sizes)
        out = ((self.matrix[:, rows].T * self.heavy) @ self.matrix).astype(np.float64)
        own = self.edge[rows + 1] - self.edge[rows]
        shingle, at = self.shingles[_ranges(self.edge[rows], own)], np.repeat(np.arange(len(rows)), own)
        n = self.n[shingle]
        turn = np.cumsum(n) // 4_000_000
        for t in np.unique(turn):
            these = turn == t
            s, m = shingle[these], n[these]
            hit = np.repeat(at[these] * g, m) + self.sets[_ranges(self.begin[s], m)]
            out += np.bincount(hit, np.repeat(self.weight[s], m), minlength=out.size).reshape(out.shape)
        out[np.arange(len(rows)), rows] = self.sizes[rows]
        return out

    def near(self, rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether each of the sets named is linked to every set, and its distance."""
        common = self.common(rows)
        union = self.sizes[rows][:, None] + self.sizes - common
        return 100 * common >= percent * union, 1 - common / union


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())


def join_family(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """For each set the number of the first one of its component; sets are distinct and not empty. Each set is held against
    the others once at most, and a pivot with a cell once more."""
    family, g = _Family(sets), len(sets)
    root, radius = list(range(g)), 1 - percent / 100 + 1e-9

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def unite(x: int, y: int) -> None:
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)

    # pivots and their cells; as many documents are tried at a time as became pivots lately
    free, step, most = np.ones(g, bool), 1, max(1, 4_000_000 // g)
    cell, away, is_pivot = np.full(g, -1), np.full(g, np.inf), np.zeros(g, bool)
    while free.any():
        tried = np.flatnonzero(free)[:step]
        linked, distance = family.near(tried, percent)
        used = 0
        for p, links, d in zip(tried.tolist(), linked, distance):
            if not free[p]:
                continue
            used, is_pivot[p] = used + 1, True
            members = np.flatnonzero(links)
            free[members] = False
            closer = members[d[members] < away[members]]
            cell[closer], away[closer] = p, d[closer]
            for x in members.tolist():
                unite(p, x)
        step = min(most, step * 2) if 2 * used > step else 1
    cell[is_pivot] = np.flatnonzero(is_pivot)
    # cells that may hold a link to another one: a member x of p's cell with a partner in q's has d(x, p) >= d(p, q) - 2r
    pivots, order = np.flatnonzero(is_pivot), np.argsort(cell, kind="stable")
    size = np.bincount(cell, minlength=g)
    begin = np.cumsum(size) - size
    several = pivots[size[pivots] > 1]
    for i in range(0, len(several), most):
        part = several[i : i + most]
        _, distance = family.near(part, percent)
        for p, d in zip(part.tolist(), distance):
            others = pivots[d[pivots] <= 3 * radius]
            gap = min((float(d[q]) for q in others.tolist() if find(q) != find(p)), default=np.inf)
            x = order[begin[p] : begin[p] + size[p]]
            x = x[(x != p) & (away[x] >= gap - 2 * radius)]
            for j in range(0, len(x), most):
                linked, _ = family.near(x[j : j + most], percent)
                for a, links in zip(x[j : j + most].tolist(), linked):
                    for y in np.flatnonzero(links).tolist():
                        unite(a, y)
    return np.array([find(x) for x in range(g)])


def _by_group(batches, column: str) -> Iterator[pa.Table]:
    """Whole groups of rows that come sorted by a column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        v = np.asarray(batch.column(column))
        cuts = [0, *(np.flatnonzero(v[1:] != v[:-1]) + 1).tolist(), len(v)]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[-1].column(column)[0].as_py() != v[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _sets(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def _join_small(members: DataFrame, percent: int) -> DataFrame:
    """a, b: links that connect the components of each family (family, _row, set)."""
    def join(batches):
        for t in _by_group(batches, "family"):
            rows = np.asarray(t.column("_row"))
            first = join_family(_sets(t.column("set")), percent)
            moved = first != np.arange(len(first))
            if moved.any():
                yield pa.RecordBatch.from_arrays([pa.array(rows[moved]), pa.array(rows[first[moved]])], names=["a", "b"])

    n = shuffle_partitions(members.sparkSession)
    return members.select("family", "_row", "set").repartition(n, "family").sortWithinPartitions("family", "_row").mapInArrow(frugal(join), "a long, b long")


def _join_large(spark: SparkSession, members: DataFrame, percent: int, pivots: int, made: list[DataFrame]) -> DataFrame:
    """One round of document pivots over large families (family, _row, n, set): adds links to made, and returns the members
    that are in no cell. A family is dealt over blocks of about FAMILY shingles, each of which is handed the pivots."""
    radius = 1 - percent / 100 + 1e-9
    order = Window.partitionBy("family").orderBy(F.xxhash64("_row"), "_row")
    chosen = members.select("family", "_row").withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= pivots).select("_row")
    blocks = members.groupBy("family").agg(F.ceil(F.sum("n") / FAMILY).cast("int").alias("blocks"))
    dealt = members.join(F.broadcast(blocks), "family").select("family", F.pmod(F.xxhash64("_row"), F.col("blocks")).alias("block"), "_row", "set")
    heads = materialise(spark, members.join(F.broadcast(chosen), "_row", "left_semi"), "heads").join(F.broadcast(blocks), "family").select("family", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"), "_row", "set")

    def measure(key, left, right):
        sets, rows = _sets(left.column("set")), left.column("_row").to_pylist()
        ids, index = np.asarray(right.column("_row")), _Index(_sets(right.column("set")))
        out = []
        for row, s in zip(rows, sets):
            which, common = index.common(s)
            size = index.sizes[which]
            d, linked = 1 - common / (len(s) + size - common), _linked(common, len(s), size, percent)
            if not linked.any():
                out.append((row, None, None, False))
            out += [(row, int(p), float(x), bool(k)) for p, x, k in zip(ids[which], d, linked) if k or x <= 2 * radius]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64(), pa.bool_()))] if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.bool_())], names=["_row", "pivot", "d", "linked"])

    found = materialise(spark, dealt.groupBy("family", "block").cogroup(heads.groupBy("family", "block")).applyInArrow(measure, "_row long, pivot long, d double, linked boolean"), "cells")
    stars = found.where("linked").select(F.col("_row").alias("a"), F.col("pivot").alias("b"))
    made.append(stars)
    # Voronoi cells: a member belongs to the nearest of the pivots it is linked to
    cells = found.where("linked").groupBy("_row").agg(F.min(F.struct("d", "pivot")).alias("m")).select("_row", "m.pivot", "m.d")
    # others within 2r of a pivot, unless the links to pivots tie them to it already
    tied = components(spark, stars).select(F.col("node").alias("_row"), "component")
    others = found.where(F.col("pivot").isNotNull() & ~F.col("linked")).select("pivot", "_row", "d").join(tied, "_row", "left")
    others = others.join(tied.select(F.col("_row").alias("pivot"), F.col("component").alias("_c")), "pivot").where(~F.col("component").eqNullSafe(F.col("_c"))).select("pivot", "_row", "d")
    others = materialise(spark, others, "others")
    # a cell and the others of its window, both in blocks; every block of one meets every block of the other
    outer = others.groupBy("pivot").agg(F.min("d").alias("least"), F.ceil(F.count("*") / CELL).cast("int").alias("js"))
    cell = cells.join(F.broadcast(outer), "pivot").where(F.col("d") >= F.col("least") - radius)
    tiles = cell.groupBy("pivot").agg(F.ceil(F.count("*") / CELL).cast("int").alias("is"), F.first("js").alias("js"))
    part = lambda n: F.pmod(F.xxhash64("_row"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inside = cell.select("pivot", "_row").join(F.broadcast(tiles), "pivot").select("pivot", "_row", part("is").alias("i"), every("js").alias("j"), F.lit(True).alias("inside"))
    outside = others.select("pivot", "_row").join(F.broadcast(tiles), "pivot").select("pivot", "_row", every("is").alias("i"), part("js").alias("j"), F.lit(False).alias("inside"))
    placed = _listed(spark, inside.unionByName(outside).select("_row", F.xxhash64("pivot", "i", "j").alias("tile"), "inside"), "tiles")
    placed = members.join(placed, "_row").select("tile", "_row", "set", "inside")

    def compare(batches):
        for t in _by_group(batches, "tile"):
            mine = t.column("inside").to_numpy()
            rows, sets = np.asarray(t.column("_row")), _sets(t.column("set"))
            if not mine.any() or mine.all():
                continue
            index = _Index([s for s, k in zip(sets, mine) if k])
            ids, out = rows[mine], []
            for i in np.flatnonzero(~mine):
                which, common = index.common(sets[i])
                hit = which[_linked(common, len(sets[i]), index.sizes[which], percent)]
                if len(hit):  # the cell is connected already: one link says all
                    out.append((int(rows[i]), int(ids[hit[0]])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    n = shuffle_partitions(spark)
    made.append(materialise(spark, placed.repartition(n, "tile").sortWithinPartitions("tile", "_row").mapInArrow(frugal(compare), "a long, b long"), "boundary"))
    return members.join(_listed(spark, found.where("pivot is null").select("_row"), "uncovered"), "_row", "left_semi")


def _listed(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows without texts or sets, written, and broadcast if their number is within the bound."""
    stored = materialise(spark, rows, name)
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


# --- the join -------------------------------------------------------------------------------------------------------


def similar_documents(spark: SparkSession, docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id, text).

    Two documents are linked when 100 * common >= percent * union of their shingle sets; the component is the smallest
    doc_id reachable. Texts of fewer words are one shingle; null, empty and blank texts have none and are linked with
    nothing. Repeated doc_ids are rows of their own that share what their id reaches; a null doc_id is never a component's
    smallest unless it is alone, and then stays null. Empty tables give an empty result; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("_row"), "text")
    measured, measured_path = materialise_at(spark, _measure(rows, words), "sets")
    whole = measured.where(F.col("bucket").isNull())
    known = whole.where((F.col("n") > 0) & F.col("_row").isNotNull())
    classes, _ = materialise_at(spark, known.groupBy("node", "key").agg(F.min("_row").alias("rep"), F.first("n").alias("n"), F.first("counts").alias("counts")), "classes")
    own = materialise(spark, whole.select("_row", "n", "node"), "rows")
    known = own.where((F.col("n") > 0) & F.col("_row").isNotNull())

    above = FREQUENT
    while True:
        frequent, frequent_path = materialise_at(spark, _frequent(measured, above), "frequent")
        if frequent.count() <= MAX_FREQUENT:
            break
        drop_table(spark, frequent_path)
        above *= 2
    listed = frequent.toPandas().sort_values("head")  # at most MAX_FREQUENT rows
    handed = spark.sparkContext.broadcast((listed["head"].to_numpy(np.uint32), np.log2(listed["n"].to_numpy(float)).astype(np.uint8)))
    drop_table(spark, frequent_path)
    drop_table(spark, measured_path)
    regions, regions_path = materialise_at(spark, _regions(_first_shingles(rows.where("_row is not null").select("text"), handed, words, percent)), "regions")
    # rows that repeat a doc_id tie their classes together
    several = known.groupBy("_row").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("_row", "a")
    repeated = materialise(spark, several.join(known.select("_row", F.col("node").alias("b")), "_row").select("a", "b").where("a <> b").distinct(), "repeated")
    edges, edges_path = materialise_at(spark, _candidates(spark, regions, classes, percent), "candidates")
    drop_table(spark, regions_path)
    release_shuffles(spark)
    families = components(spark, edges)
    drop_table(spark, edges_path)

    # the classes' sets, with the family they are joined in
    chosen = classes.select("node", "key", "rep").join(families.select("node", F.col("component").alias("family")), "node")
    chosen, _ = materialise_at(spark, chosen, "chosen")
    picked = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
    found = rows.join(picked.select(F.col("rep").alias("_row"), F.col("key").alias("_key"), "node", "family"), "_row")

    def fetch(batches):
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), words)
            ok = [xxhash.xxh128_digest(s.tobytes()) == k for s, k in zip(sets, batch.column("_key").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("family"), batch.column("node"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["family", "_row", "n", "set"]).filter(pa.array(ok, pa.bool_()))

    members, members_path = materialise_at(spark, found.select("family", "node", "_key", "text").mapInArrow(frugal(fetch), "family long, _row long, n long, set binary"), "members", "uncompressed")
    release_shuffles(spark)
    made: list[DataFrame] = []
    rest, pivots = members, PIVOTS
    while True:
        large = rest.groupBy("family").agg(F.sum("n").alias("total"), F.count("*").alias("sets"))
        large = large.where((F.col("total") > FAMILY) | (F.col("total") * F.col("sets") > WORK)).select("family")
        large = F.broadcast(materialise(spark, large, "large"))  # fewer than one for each 80,000 shingles
        made.append(materialise(spark, _join_small(rest.join(large, "family", "left_anti"), percent), "small"))
        if large.isEmpty():
            break
        rest = materialise(spark, _join_large(spark, rest.join(large, "family", "left_semi"), percent, pivots, made), "rest", "uncompressed")
        pivots *= 2
    drop_table(spark, members_path)
    release_shuffles(spark)
    links = repeated
    for x in made:
        links = links.unionByName(x.select("a", "b"))
    joined = components(spark, links)
    smallest = joined.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("component_id"))
    of_node = classes.select("node", "rep").join(joined, "node", "left").join(smallest, "component", "left").select("node", F.coalesce("component_id", "rep").alias("component_id"))
    # classes are rows of one each; a class that a third of all rows are of is split by adaptive execution
    out = own.select("_row", "n", F.when((F.col("n") > 0) & F.col("_row").isNotNull(), F.col("node")).alias("node")).join(of_node, "node", "left")
    return out.select(F.col("_row").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "_row").alias("component_id"))
