"""Best-fit packing of token pieces into sequences of a fixed capacity, by linear grouping.

Pieces of the same length can stand for one another, so the packing is planned on the histogram of lengths (at most
``capacity`` counters, whatever the corpus) and applied to the rows by rank:

1. lengths above ``large`` are put into ``groups`` groups of equal cardinality, each rounded up to its longest member;
2. the linear programme over configurations of these few sizes is solved by column generation (a knapsack prices the
   next configuration) and rounded down; what is left over goes by best fit, longest first;
3. actual lengths take the places of the rounded ones in their group, longest first;
4. the small ones are placed by best fit, longest first: each into the fullest sequence that still has room.

Several settings of the two parameters are planned and the plan with the fewest sequences is kept.

Edge cases: null text counts as empty (a piece with the end id alone); every row of a repeated doc_id is packed by itself;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabflow.llm.common import frugal, materialise, slices
from tabflow.llm.tokens import encoder

#: (a length counts as large above this share of the capacity, number of groups); all are tried.
SETTINGS = ((1 / 4, 24), (1 / 3, 60), (1 / 2, 16))
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, chunk int, nth long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """A row per piece of every document. A document longer than the capacity is cut into full pieces, the first of which
    may be shorter. ``chunk`` is the task and ``nth`` counts the pieces of the same length in it; write the table before
    use, so that both are fixed."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    names = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]

    def cut(batches):
        enc, chunk, seen = encoder(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text"):
            out = []
            for key, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text"))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                edges = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    part = ids[a:b].tobytes()
                    out.append((key, piece, a, b - a, part, zlib.crc32(part), chunk, int(seen[b - a])))
                    seen[b - a] += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return rows.mapInArrow(frugal(cut), PIECE_SCHEMA)


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable configuration: how many of each size."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for k in np.argsort(-sizes):
        s, v = int(sizes[k]), values[k]
        if v <= 0:
            continue
        for _ in range(capacity // s):  # once more each time; settles after as many passes as fit
            better = best[:-s] + v > best[s:] + 1e-12
            if not better.any():
                break
            gain = np.where(better, best[:-s] + v, best[s:])
            took[s:][better] = k
            best[s:] = gain
    config, room = np.zeros(len(sizes), np.int64), int(np.argmax(best))
    total = 0.0
    while room > 0 and took[room] >= 0:
        k = took[room]
        config[k] += 1
        total += values[k]
        room -= int(sizes[k])
    return total, config


def _configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Configurations and how often to use them, at fewest sequences in fractions: column generation, as a revised simplex
    with one basic configuration for each size."""
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(40 * k):
        duals = np.linalg.solve(basis.T, np.ones(k))
        value, config = _knapsack(sizes, duals, capacity)
        if value <= 1 + 1e-7:
            break
        x, d = np.linalg.solve(basis, demand), np.linalg.solve(basis, config)
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = config
    return basis.T.round().astype(np.int64), np.maximum(np.linalg.solve(basis, demand), 0)


def _best_fit(room: dict[int, list], lengths: list[tuple[int, int]], capacity: int, done: list) -> None:
    """Place (length, count), longest first, each into the fullest sequence with room. room: by what is left, the lists of
    (what a sequence holds as (length, times), how many such sequences); changed in place."""
    left = sorted(room)
    import bisect

    def put(r: int, entry: tuple) -> None:
        if r == 0:
            done.append(entry)
            return
        if r not in room:
            room[r] = []
            bisect.insort(left, r)
        room[r].append(entry)

    for length, count in lengths:
        while count:
            at = bisect.bisect_left(left, length)
            if at == len(left):
                q = capacity // length
                full, rest = divmod(count, q)
                if full:
                    put(capacity - q * length, (((length, q),), full))
                if rest:
                    put(capacity - rest * length, (((length, rest),), 1))
                break
            r = left[at]
            held, m = room[r].pop()
            if not room[r]:
                del room[r]
                left.pop(at)
            q = r // length
            full = min(m, count // q)
            if full:
                put(r - q * length, ((*held, (length, q)), full))
                count -= full * q
                m -= full
            if m and count and count < q:
                put(r - count * length, ((*held, (length, count)), 1))
                count, m = 0, m - 1
            if m:
                put(r, (held, m))


def plan_sequences(histogram: dict[int, int], capacity: int, large: float, groups: int) -> list[tuple[tuple, int]]:
    """Sequences as (what each holds as (length, times), how many such sequences)."""
    done: list = []
    room: dict[int, list] = {}
    big = sorted(((n, c) for n, c in histogram.items() if capacity > n > large * capacity), reverse=True)
    small = sorted(((n, c) for n, c in histogram.items() if n <= large * capacity), reverse=True)
    if full := histogram.get(capacity):
        done.append((((capacity, 1),), full))
    if big:
        # equal cardinality: cut the descending list where the count passes each share
        total, passed, members = sum(c for _, c in big), 0, []
        for n, c in big:
            while c:
                g = min(groups - 1, passed * groups // total)
                take = min(c, max(1, -(-(g + 1) * total // groups) - passed)) if g < groups - 1 else c
                if len(members) <= g:
                    members += [[] for _ in range(g + 1 - len(members))]
                members[g].append([n, take])
                passed, c = passed + take, c - take
        members = [m for m in members if m]
        sizes = np.array([m[0][0] for m in members])
        demand = np.array([sum(c for _, c in m) for m in members], float)
        configs, times = _configurations(sizes, demand, capacity)
        for config, x in zip(configs, np.floor(times + 1e-6).astype(int)):
            places = [g for g in np.flatnonzero(config) for _ in range(config[g])]
            while x > 0 and places:
                # as many sequences at once as keep every place at one actual length
                lengths, span, used = [], x, {}
                for g in places:
                    queue = members[g]
                    skip = used.get(g, 0)
                    if skip >= len(queue):
                        span = 0
                        break
                    lengths.append(queue[skip][0])
                    used[g] = skip
                    span = min(span, queue[skip][1] // places.count(g))
                if span == 0:  # fewer left than this configuration asks for at one length: take one sequence, piece by piece
                    lengths = []
                    for g in places:
                        while members[g] and not members[g][0][1]:
                            members[g].pop(0)
                        if members[g]:
                            lengths.append(members[g][0][0])
                            members[g][0][1] -= 1
                    span = 1
                else:
                    for g in places:
                        members[g][0][1] -= span
                for g in set(places):
                    while members[g] and not members[g][0][1]:
                        members[g].pop(0)
                if not lengths:
                    break
                held = tuple((n, lengths.count(n)) for n in dict.fromkeys(lengths))
                rest = capacity - sum(lengths)
                (done if rest == 0 else room.setdefault(rest, [])).append((held, span))
                x -= span
        left: dict[int, int] = {}
        for m in members:
            for n, c in m:
                left[n] = left.get(n, 0) + c
        small = sorted([(n, c) for n, c in left.items() if c] + small, reverse=True)
    _best_fit(room, small, capacity, done)
    return done + [entry for entries in room.values() for entry in entries]


def plan_runs(histogram: dict[int, int], capacity: int) -> tuple[pd.DataFrame, int]:
    """The best plan as runs: pieces of a length with ranks from rank_from on go, ``times`` to a sequence, into
    consecutive sequences from seq_from on, the first at offset. Returns the runs and the number of sequences."""
    plans = [plan_sequences(histogram, capacity, *s) for s in SETTINGS] if histogram else [[]]
    best = min(plans, key=lambda p: sum(m for _, m in p))
    used, sequence, runs = dict.fromkeys(histogram, 0), 0, []
    for held, m in best:
        offset = 0
        for length, times in held:
            runs.append((length, used[length], times, sequence, offset))
            used[length] += m * times
            offset += length * times
        sequence += m
    if used != histogram:
        raise AssertionError("the plan does not hold every piece once")
    table = pd.DataFrame(runs, columns=["length", "rank_from", "times", "seq_from", "offset"])
    return table.sort_values(["length", "rank_from"], ignore_index=True), sequence


def assign(spark: SparkSession, pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces (length, chunk, nth and any other columns).

    The driver sees one count for each length. A piece's rank among its length is nth plus what earlier chunks have of the
    length; these sums are joined on (chunk, length), of which no pair has more than a chunk's rows.
    """
    counts = pieces.groupBy("chunk", "length").agg(F.count("*").alias("_n"))
    histogram = dict(counts.groupBy("length").agg(F.sum("_n")).collect())
    runs, _ = plan_runs(histogram, capacity)
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("chunk", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    ranked = pieces.join(base, ["chunk", "length"]).withColumn("_rank", F.col("_base") + F.col("nth"))
    arrays = spark.sparkContext.broadcast({c: runs[c].to_numpy(np.int64) for c in runs.columns})  # bounded by the capacity, not by rows
    keep = [f for f in ranked.schema.fields if f.name not in ("_base", "_rank", "chunk", "nth")]

    def place(batches):
        r = arrays.value
        key = r["length"] * (1 << 44) + r["rank_from"]
        for pdf in batches:
            rank, length = pdf["_rank"].to_numpy(np.int64), pdf["length"].to_numpy(np.int64)
            at = np.searchsorted(key, length * (1 << 44) + rank, side="right") - 1
            q, m = np.divmod(rank - r["rank_from"][at], r["times"][at])
            yield pdf[[f.name for f in keep]].assign(sequence_id=r["seq_from"][at] + q, offset=r["offset"][at] + m * length)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + ", sequence_id long, offset long"
    return ranked.mapInPandas(frugal(place), schema)


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """Pack docs (doc_id, text): a row per piece with doc_id, piece, start, length, ids (binary, unsigned 32-bit
    little-endian; left out unless with_ids), ids_crc32, sequence_id and offset."""
    pieces = materialise(spark, cut_pieces(docs, tokenizer, capacity, end_id), "pieces")
    return assign(spark, pieces if with_ids else pieces.drop("ids"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Join the pieces of each sequence to its ids: sequence_id, ids, n_tokens. A sequence holds at most the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("_p"), F.sum("length").alias("n_tokens")).select(
        "sequence_id", F.aggregate("_p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"), "n_tokens")
