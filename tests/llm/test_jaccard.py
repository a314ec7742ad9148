"""The Jaccard join against brute force."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from tabflow.llm import jaccard
from tabflow.llm.components import components

from .conftest import ODD_TEXTS, frame

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return Counter((i, len(s), None if i is None else find(i)) for i, s in sets)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    passage = rng.choices(words, k=30)
    bases = [rng.choices(words, k=rng.choice([4, 6, 20, 80, 300])) for _ in range(12)]
    rows = []
    for i in range(n):
        t = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, len(t) // 30, len(t) // 12])):
            t[rng.randrange(len(t))] = rng.choice(words)
        if rng.random() < 0.3:
            at = rng.randrange(len(t) + 1)
            t[at:at] = passage
        rows.append((i * 3 + 1, " ".join(t).upper() if rng.random() < 0.2 else "\t".join(t)))
    rng.shuffle(rows)
    return rows


def run(spark, rows):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(spark, frame(spark, rows)).collect())


def test_odd_texts(spark, odd):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(spark, odd).collect())
    assert got == brute(ODD_TEXTS)


def test_small_families(spark):
    rows = corpus(1)
    assert run(spark, rows) == brute(rows)


def test_large_families(spark, monkeypatch):
    for name, value in (("FAMILY", 800), ("PIVOTS", 2), ("CELL", 3), ("BROADCAST_ROWS", 1), ("FREQUENT", 3)):
        monkeypatch.setattr(jaccard, name, value)
    rows = corpus(2)
    assert run(spark, rows) == brute(rows)


def test_nothing(spark, empty):
    assert jaccard.similar_documents(spark, empty).collect() == []


def test_repeated_ids_tie_their_texts(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    rows = [(5, a), (9, b), (5, b), (7, a), (8, "x y z x y z")]
    got = {(r.doc_id, r.component_id) for r in jaccard.similar_documents(spark, frame(spark, rows)).collect()}
    assert got == {(5, 5), (9, 5), (7, 5), (8, 8)}


@pytest.mark.parametrize("seed", range(20))
def test_join_in_memory(seed):
    rng = np.random.default_rng(seed)
    bases = [rng.integers(0, 400, 40) for _ in range(4)]
    sets = []
    for _ in range(60):
        s = bases[rng.integers(4)].copy()
        s[rng.integers(0, 40, rng.integers(0, 9))] = rng.integers(0, 400)
        sets.append(np.unique(s).astype(np.uint64))
    distinct = list({x.tobytes(): x for x in sets}.values())
    got = jaccard.join_family(distinct)
    root = list(range(len(distinct)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for j, b in enumerate(distinct[:i]):
            common = len(np.intersect1d(a, b))
            if 100 * common >= 75 * (len(a) + len(b) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert got.tolist() == [find(i) for i in range(len(distinct))]


def test_many_sets_that_share_most(spark):
    """Thousands of sets of one family, four fifths shared and not linked, and some linked ones among them, in seconds."""
    rng = np.random.default_rng(5)
    shared = np.arange(400, dtype=np.uint64)
    sets = [np.sort(np.concatenate([shared, 1000 + k * 100 + np.arange(100, dtype=np.uint64)])) for k in range(2000)]
    for k in range(0, 600, 3):  # a chain of three: the first is not linked to the third
        own = sets[k][400:]
        sets[k + 1] = np.sort(np.concatenate([shared, own[:40], 10**6 + k * 100 + np.arange(60, dtype=np.uint64)]))
        sets[k + 2] = np.sort(np.concatenate([shared, sets[k + 1][440:], 2 * 10**6 + k * 100 + np.arange(40, dtype=np.uint64)]))
    sets = [sets[i] for i in rng.permutation(2000)]
    start = time.time()
    got = jaccard.join_family(sets)
    assert time.time() - start < 30
    names = np.unique(np.concatenate(sets), return_inverse=True)[1]
    at = np.repeat(np.arange(2000), [len(s) for s in sets])
    keep = np.isin(names, np.flatnonzero(np.bincount(names) > 1))  # the others are in one set
    few = np.unique(names[keep], return_inverse=True)[1]
    bits = np.zeros((2000, few.max() + 1), np.float32)
    bits[at[keep], few] = 1
    common = bits @ bits.T
    n = np.array([len(s) for s in sets])
    link = 100 * common >= 75 * (n[:, None] + n - common)
    np.fill_diagonal(link, True)
    root = np.arange(2000)
    while True:
        new = np.array([root[l].min() for l in link])
        if (new == root).all():
            break
        root = new
    assert got.tolist() == root.tolist() and len(set(root.tolist())) < 2000


def test_large_regions_and_work(spark, monkeypatch):
    """Regions handed on in parts, and families that are large by work."""
    for name, value in (("HELD", 5), ("SMALL", 2), ("WORK", 3000), ("FREQUENT", 2), ("PIVOTS", 3), ("CELL", 4)):
        monkeypatch.setattr(jaccard, name, value)
    rows = corpus(7)
    assert run(spark, rows) == brute(rows)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = dict(components(spark, frame(spark, edges, "a long, b long")).collect())
    assert got == {x: find(x) for x in root}
    assert components(spark, frame(spark, [], "a long, b long")).collect() == []
