"""Centroid clusters, vector codes and token counts against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabflow.llm import blocks, codes, counts, queries, shallot
from tests.conftest import SF01, SF001
from tests.oracle_check import compare, duck

from .conftest import ODD_TEXTS, frame

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def vectors(seed, n=300, size=64, groups=9):
    """Vectors around a few centres, with equal ones, repeated ids and ties; and rows that are not kept."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.2, (groups, size))
    v = np.round(centres[rng.integers(groups, size=n)] + rng.normal(0, 0.03, (n, size)), 3).astype(np.float32)
    v[n // 2 : n // 2 + 30] = v[0]
    rows = [(int(i), x.tolist(), int(i) % 4 if i % 7 else None) for i, x in zip(rng.permutation(n) * 5, v)]
    rows += [(7, v[1].tolist(), 1), (7, v[1].tolist(), 1), (None, v[2].tolist(), None)]
    odd = [None, [], [None] * size, [NAN] + [0.0] * (size - 1), [INF] + [0.0] * (size - 1)]
    return rows, rows + [(10_000 + i, x, 2) for i, x in enumerate(odd)]


def brute_clusters(rows, k, rounds, size=64):
    ids, x = [r[0] for r in rows], np.array([np.floor(256 * np.array(r[1], np.float32).astype(float)) for r in rows]).astype(np.int64)
    place = sorted(range(len(rows)), key=lambda i: (ids[i] is None, hashlib.sha256(f"2:{ids[i]}".encode()).hexdigest(), rows[i][1]))
    c = x[place[:k]]
    for t in range(rounds + 1):
        d = ((x[:, None, :] - c[None]) ** 2).sum(-1)
        a = d.argmin(1)  # the first of equals
        if t < rounds:
            c = np.stack([x[a == j].sum(0) // max(1, (a == j).sum()) if (a == j).any() else c[j] for j in range(len(c))])
    own = d[np.arange(len(x)), a]
    sha = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c.tolist()]
    return Counter((i, int(j), int(e), int(own[a == j].sum()), int(own.sum()), sha[j]) for i, j, e in zip(ids, a, own))


@pytest.mark.parametrize("k, rounds, block", [(40, 5, 64), (1, 2, 4096), (400, 2, 50), (7, 9, 100)])
def test_clusters_equal_brute_force(spark, monkeypatch, k, rounds, block):
    monkeypatch.setattr(blocks, "BLOCK", block)
    kept, rows = vectors(k)
    rows += [(3, [0.5] * 8, 1)]
    table = frame(spark, [(*r, "x") for r in rows], SCHEMA + ", cluster string").repartition(3)
    got = shallot.centroid_clusters(spark, table, k=k, rounds=rounds)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute_clusters(kept, k, rounds)


def test_search_computes_few_distances():
    """The bounds and the ball spare most distances once the centroids have settled."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-2000, 2000, (40, 64))
    x = centres[rng.integers(40, size=3000)] + rng.integers(-50, 50, (3000, 64))
    c, moved = x[:40].copy(), None
    a, b, u, low = np.zeros(3000, np.int32), np.ones(3000, np.int32), np.full(3000, np.inf), np.zeros(3000)
    met = []
    for _ in range(6):
        met.append(shallot.Ring(c, moved).assign(x, a, b, u, low))
        d = ((x[:, None, :] - c[None]) ** 2).sum(-1)
        assert (a == d.argmin(1)).all()
        new = np.stack([x[a == j].sum(0) // max(1, (a == j).sum()) if (a == j).any() else c[j] for j in range(40)])
        moved, c = ((new - c) ** 2).sum(1), new
    assert met[-1] < 3000 * 4 < 3000 * 40 / 5


def brute_codes(rows, entries, rounds, parts=8):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    x = np.array([np.floor(4096 * np.array(r[1], np.float32).astype(float)) for r in rows]).astype(np.int64)
    cut, code, error, book = np.split(x, parts, axis=1), [], 0, []
    for p in cut:
        c = p[order[:entries]]
        for t in range(rounds + 1):
            d = ((p[:, None, :] - c[None]) ** 2).sum(-1)
            a = d.argmin(1)
            if t < rounds:
                c = np.stack([p[a == j].sum(0) // max(1, (a == j).sum()) if (a == j).any() else c[j] for j in range(len(c))])
        code.append(a)
        error = error + d.min(1)
        book += c.reshape(-1).tolist()
    sha, labels = hashlib.sha256(",".join(map(str, book)).encode()).hexdigest(), Counter()
    for r, e in zip(rows, error):
        labels[r[2]] += int(e)
    return Counter((r[0], "".join(f"{a[i]:02x}" for a in code), int(error[i]), labels[r[2]], sha) for i, r in enumerate(rows))


@pytest.mark.parametrize("entries, rounds, block, size, wide", [(16, 6, 64, 64, 1), (1, 1, 4096, 16, 1), (250, 2, 90, 32, 0), (5, 4, 37, 64, 0)])
def test_codes_equal_brute_force(spark, monkeypatch, entries, rounds, block, size, wide):
    monkeypatch.setattr(blocks, "BLOCK", block)
    monkeypatch.setattr(codes, "BROADCAST_ROWS", 100 * wide)
    kept, rows = vectors(entries, size=size)
    rows += [(300_000, [0.5] * 8 * 100, 1)]  # of another length
    table = frame(spark, [(*r, "x") for r in rows], SCHEMA + ", code string").repartition(3)
    got = codes.vector_codes(spark, table, entries=entries, rounds=rounds)
    assert Counter(tuple(r) for r in got.collect()) == brute_codes(kept, entries, rounds)


def test_trees_assign_most_nodes_whole():
    """On separate groups the pairs of nodes decide; single points are hardly compared."""
    rng = np.random.default_rng(1)
    entries = rng.integers(-5000, 5000, (16, 8))
    points = entries[rng.integers(16, size=4000)] + rng.integers(-20, 20, (4000, 8))
    tree = codes.Tree(points, codes.LEAF)
    code, whole, met = codes.dual_assign(tree, entries)
    assert (code == ((tree.points[:, None, :] - entries[None]) ** 2).sum(-1).argmin(1)).all()
    covered = sum(int(np.diff(tree.edges[level])[nodes].sum()) for level, nodes, _ in whole)
    assert covered > 3000 and met < 4000 * 2


@pytest.mark.parametrize("seed", range(8))
def test_trees_with_ties(seed):
    rng = np.random.default_rng(seed)
    points = rng.integers(-2, 3, (int(rng.integers(1, 200)), 3))
    entries = rng.integers(-2, 3, (int(rng.integers(1, 20)), 3))
    tree = codes.Tree(points, 4)
    assert (codes.dual_assign(tree, entries)[0] == ((tree.points[:, None, :] - entries[None]) ** 2).sum(-1).argmin(1)).all()
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    assert all((s.sum(0) == points.sum(0)).all() for s in tree.sums())


def test_no_vectors(spark):
    nothing = frame(spark, [], SCHEMA)
    unkept = frame(spark, [(1, None, 1), (2, [], None), (None, [NAN], 3)], SCHEMA)
    for table in (nothing, unkept):
        assert shallot.centroid_clusters(spark, table).collect() == [] and codes.vector_codes(spark, table).collect() == []
    uneven = frame(spark, [(1, [0.1] * 12, 1)], SCHEMA)
    assert codes.vector_codes(spark, uneven).collect() == []


def test_components_beyond_the_limit_are_refused(spark):
    with pytest.raises(ValueError, match="64 bits"):
        shallot.centroid_clusters(spark, frame(spark, [(1, [1e30] * 64, 1)], SCHEMA))


@pytest.mark.parametrize("name", ["op11_centroid_clusters", "op12_vector_codes"])
def test_queries_equal_their_sql(spark, name):
    result = compare(queries.QUERIES[name](spark, SF01), duck(SF01), queries.ORACLE_SQL[name])
    assert result["ok"], result


# --- token counts ---------------------------------------------------------------------------------------------------

WORDS = public_tokenizers.path("word_bpe_49k.json")
TRICKY = ["It's we'll DON'T 'tis rock'n'roll's", "a<|endoftext|>b <|ENDOFTEXT|> x<|startoftext|><|endoftext|>", "ÀÉ ΌΣΟΣ ΣΑΣ İstanbul ſ ǅ", "café é́ ́ x y z　q r",
          "no\x00null \x1c\x1d\x1e\x1f \x85 \x0b\x0c", "日本語 テスト 3½² ⅷ 12,345.67", "ﬁ ﬃ Å Å 가각 가", "a‍b ​ ️❤️ 👩‍👩‍👧", "--- ... ?!?! $$", "x" * 300 + " " + "yz" * 5000, "<|endoftext|>", "'", "’s ’", "Abc, abc. ABC?! abc's, a,b x'. \"Quoted,\" (paren). aé, x;;: É. <|endoftext|>, <|EndOfText|>."]


def test_pre_tokens_are_the_librarys():
    lib = Tokenizer.from_file(WORDS)
    held = counts.PreTokens(WORDS)
    assert held.by_word
    texts = TRICKY + [t for _, t in ODD_TEXTS]
    parent, number = held.of(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        mine = [held.texts.get(k, held.keys[k]) for k in number[parent == i].tolist()]
        assert mine == held.split(text or "")
        assert sum(map(held.pieces, mine)) == len(lib.encode(text or "", add_special_tokens=False).ids), text


@pytest.mark.parametrize("broadcast, cache", [(200_000, 400_000), (0, 400_000), (20, 5)])
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_equal_the_library(spark, monkeypatch, name, broadcast, cache):
    monkeypatch.setattr(counts, "BROADCAST", broadcast)
    monkeypatch.setattr(counts, "CACHE_WORDS", cache)
    path = public_tokenizers.path(name)
    lib = Tokenizer.from_file(path)
    rows = [*ODD_TEXTS, *((100 + i, t) for i, t in enumerate(TRICKY)), *((500 + i, "many equal words, many rows") for i in range(40))]
    table = frame(spark, [(*r, "x", 1) for r in rows], "doc_id long, text string, key string, _row int").repartition(3)
    got = counts.token_counts(spark, table, path, limit=9)
    expected = Counter()
    for i, t in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        expected[i, len((t or "").encode()), n, n > 9] += 1
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_count_query(spark):
    lib = Tokenizer.from_file(WORDS)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = queries.QUERIES["op13_token_counts"](spark, SF001).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}


def test_no_documents(spark, empty):
    assert counts.token_counts(spark, empty, WORDS).collect() == []


def test_vocabularies_without_pre_tokens_are_refused(tmp_path):
    from tokenizers import models

    Tokenizer(models.BPE()).save(str(tmp_path / "plain.json"))
    with pytest.raises(ValueError):
        counts.PreTokens(str(tmp_path / "plain.json"))
