"""Language models, the toxicity network and NN-descent."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabflow.llm import langid, neighbours, toxicity

from tests.conftest import SF001, SF01

from .conftest import ODD_TEXTS, frame


def _learned(rows, order=3):
    """Interpolated Kneser-Ney probabilities by hand: p(lang, context, character)."""
    grams = {}
    for text, lang in rows:
        for w in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            s = " " * (order - 1) + w + " "
            for k in range(len(s) - order + 1):
                grams.setdefault(lang, Counter())[s[k : k + order]] += 1
    alphabet = len({c for g in grams.values() for x in g for c in x}) + 1
    levels = {}
    for lang, top in grams.items():
        at = {order: top}
        for k in range(order - 1, 0, -1):
            at[k] = Counter(g[1:] for g in at[k + 1])
        levels[lang] = at

    def p(lang, gram):
        if not gram:
            return 1 / alphabet
        counts = levels[lang][len(gram)]
        own = [n for g, n in counts.items() if g[:-1] == gram[:-1]]
        below = p(lang, gram[1:])
        if not own:
            return below
        once, twice = sum(n == 1 for n in counts.values()), sum(n == 2 for n in counts.values())
        d = once / (once + 2 * twice) if once and twice else 0.5
        return max(counts[gram] - d, 0) / sum(own) + d * len(own) / sum(own) * below if gram in counts else d * len(own) / sum(own) * below

    return p


ROWS = [("the cat sat on the mat. then they thought it through", "en"), ("der hund und die katze sind da, das ist gut so", "de"), ("the dog", "en"), ("die das der", "de")]


def test_models_are_kneser_ney(spark):
    docs = spark.createDataFrame(ROWS + [(None, "en"), ("x", None)], "text string, lang string")
    model = langid.fit(spark, docs, 3)
    p = _learned(ROWS)
    texts = ["the then", "katze!", "zzz qqq", "", "1 2"]
    bits, chars = model.cross_entropies(pa.array(texts))
    assert model.langs == ["de", "en"] and chars.tolist() == [9, 6, 8, 0, 0]
    for row, text in zip(bits, texts):
        for j, lang in enumerate(model.langs):
            steps = [f"  {w} "[k : k + 3] for w in text.strip("!").split() if w.isalpha() for k in range(len(w) + 1)]
            expected = -sum(np.log2(p(lang, g)) for g in steps) / max(1, len(steps))
            assert row[j] == pytest.approx(expected, abs=1e-4)
    # the probabilities of a known context add up to one over the alphabet and what is unseen
    letters = sorted({c for t, _ in ROWS for c in t.lower() if c.isalpha()} | {" "})
    grams = np.array([[ord("t"), ord("h"), ord(c)] for c in [*letters, "一"]], np.uint32)
    assert np.exp2(model._lookup(3, grams)[:, 1]).sum() == pytest.approx(1, abs=1e-3)


def test_identify_odd_rows(spark, odd, empty):
    got = sorted(((r.doc_id, r.held_out, r.lang_pred, r.score > 0, r.rejected) for r in langid.identify(spark, odd).collect()), key=str)
    none = lambda t: not any(c.isalpha() for c in t or "")
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0
    assert got == sorted(((i, held(i), "und" if none(t) else "en", not none(t), none(t)) for i, t in ODD_TEXTS), key=str)
    assert langid.identify(spark, empty).collect() == []
    unlabelled = odd.withColumn("lang", langid.F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.identify(spark, unlabelled).collect()} == {("und", 0.0)}


def test_marks_without_a_letter_are_no_language(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "\u0301\u0308 \u20dd", None), (3, "12 \u0301", None)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[2] == got[3] == ("und", 0.0) and got[1][0] == "en"


@pytest.mark.parametrize("bound", [1, 900])
def test_a_lower_bound_of_memory_changes_no_prediction(spark, monkeypatch, bound):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").unionByName(spark.createDataFrame([(None, None, None, None, None), (10**6, "\u0301", "en", "s", 1), (10**6, "x", None, "s", 1)], "doc_id long, text string, lang string, source string, n_chars long"))
    rows = lambda: sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 4), round(r.bits, 4), r.chars, r.rejected) for r in langid.identify(spark, docs).collect()), key=str)
    whole = rows()
    monkeypatch.setattr(langid, "MAX_GRAMS", bound)
    assert rows() == whole and len({r[2] for r in whole}) > 3


def test_foreign_text_is_rejected_and_the_languages_are_told_apart(spark):
    rng = random.Random(2)
    words = {"en": "the of and that with from this have some more".split(), "de": "der die und nicht eine auch sich werden nach aus".split()}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(40)), lang) for i in range(300) for lang in [("en", "de")[i % 2]]]
    rows.append((1000, "xqzv kjwp zzxq vvkq " * 12, None))
    got = langid.identify(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert [r.doc_id for r in got if r.rejected] == [1000]
    langs = {i: lang for i, _, lang in rows}
    assert all(r.lang_pred == langs[r.doc_id] for r in got if r.doc_id != 1000)


def test_noisy_labels_do_not_let_random_strings_pass(spark):
    rng = random.Random(4)
    junk = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(n))
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    # one labelled row in fifty is noise, in every class of length; random strings without a label are to go
    noise = [(10**6 + i, junk(rng.choice([4, 12, 60])), "en") for i in range(20)]
    odd = [(2 * 10**6 + i, junk(n), None) for i, n in enumerate([4] * 30 + [12] * 30 + [60] * 30)]
    both = docs.unionByName(spark.createDataFrame(noise + odd, "doc_id long, text string, lang string"))
    got = langid.identify(spark, both).collect()
    gone = {r.doc_id for r in got if r.rejected}
    assert len(gone & {i for i, _, _ in odd}) >= 85
    assert not [r for r in got if r.doc_id < 10**6 and r.rejected and r.lang_pred != "und"]


def test_gradients_are_those_of_the_loss():
    net = toxicity.Network(1)
    inputs = toxicity.Inputs(["ab", "cde", "f", "gh", "xyzzy"])
    which, first, length, y = np.array([0, 1, 2, 3, 4, 1, 0, 2, 3]), np.array([0, 3]), np.array([3, 6]), np.array([1.0, 0.0], np.float32)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    at, mask = net._places(which, first, length, 0)
    grads = net.gradients(inputs, at, mask, y)

    def loss():
        z = net.logits(inputs.vectors(net.p).astype(np.float64), which, first, length).astype(float)
        return np.mean(np.logaddexp(0, z) - y * z)

    rng = np.random.default_rng(0)
    for name, g in grads.items():
        for _ in range(3):
            if isinstance(g, tuple):
                k, col = rng.integers(len(g[0])), int(rng.integers(g[1].shape[1]))
                place, own = (g[0][k], col), g[1][g[0] == g[0][k], col].sum()
            else:
                place = tuple(int(rng.integers(s)) for s in g.shape)
                own = g[place]
            old = net.p[name][place]
            net.p[name][place] = old + 1e-2
            up = loss()
            net.p[name][place] = old - 1e-2
            down = loss()
            net.p[name][place] = old
            assert (up - down) / 2e-2 == pytest.approx(own, rel=0.02, abs=2e-6), name


def test_windows_cover_every_word():
    counts = np.array([0, 1, 31, 32, 33, 48, 49, 1000])
    doc, first, length = toxicity._windows(counts)
    start = np.cumsum(counts) - counts
    for d, n in enumerate(counts):
        own = [(f - start[d], k) for x, f, k in zip(doc, first, length) if x == d]
        assert sorted({w for f, k in own for w in range(f, f + k)}) == list(range(n))
        assert all(k == toxicity.WINDOW for _, k in own[:-1]) and all(b[0] - a[0] == toxicity.STRIDE for a, b in zip(own, own[1:]))


def test_toxicity_is_learned(spark):
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abdeilmnorstu") for _ in range(rng.randrange(2, 8)))
    rows, labels = [], []
    for i in range(900):
        bad = i % 3 == 0
        w = [word() for _ in range(rng.choice([10, 60, 200]))]
        if bad:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w) + 1), "zorg" + rng.choice(["", "ish", "en", "um", "aka"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    labels += [(0, 0), (None, 1), (5, None)]
    rows += [(2000, None), (2001, ""), (2002, "  "), (2003, "zorgelot " * 20_000), (2003, "zorgelot " * 20_000)]
    got = toxicity.toxicity(spark, frame(spark, rows), frame(spark, labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].score == 0 and by[i].predicted == 0 for i in (2000, 2001, 2002)) and by[2003].predicted == 1
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert np.mean([r.predicted == (r.doc_id % 3 == 0) for r in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_toxicity_without_labels(spark, odd, empty):
    labels = frame(spark, [], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(spark, odd, labels).collect()} == {0.0}
    assert toxicity.toxicity(spark, empty, labels).collect() == []
    ones = frame(spark, [(i, 1) for i, _ in ODD_TEXTS], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(spark, odd, ones).collect()} == {1.0}


def _brute(rows, t=0.95):
    ok = [(k, np.array(v, float)) for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ok)):
        for b in range(a):
            (i, x), (j, y) = ok[a], ok[b]
            if len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= t:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return Counter((i, links[k], low.get(find(k))) for k, (i, _) in enumerate(rows))


def _vectors(seed, n=400):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((40, 16))
    rows = [(int(i) * 2, (centres[rng.integers(40)] + rng.choice([0, 0.02, 0.15, 0.25, 0.6]) * rng.standard_normal(16)).astype(np.float32).tolist()) for i in rng.permutation(n)]
    return rows


def _run(spark, rows):
    got = neighbours.near_duplicates(spark, frame(spark, [(*r, "clash") for r in rows], "vec_id long, embedding array<float>, v string")).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return Counter((r.vec_id, r.n_links, r.component_id) for r in got)


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE", 7)  # components of many tiles
    rows = _vectors(1)
    assert _run(spark, rows) == _brute(rows)


def test_pairs_beside_a_hot_group_are_found(spark, monkeypatch):
    for name in ("ORDERS", "NEXT", "ROUNDS"):  # a descent that misses most pairs
        monkeypatch.setattr(neighbours, name, 1)
    rng = np.random.default_rng(4)
    near = lambda v, by: v / np.linalg.norm(v) + by * rng.standard_normal(48) / np.sqrt(48)
    hot, pairs = rng.standard_normal(48), rng.standard_normal((150, 48))
    vectors = [near(hot, 0.05) for _ in range(400)] + [near(v, 0.2) for v in pairs for _ in range(2)] + list(rng.standard_normal((300, 48)))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    assert _run(spark, rows) == _brute(rows)
    monkeypatch.setattr(neighbours, "AUDIT", 25)  # audits of a part, which go on until they show the recall
    monkeypatch.setattr(neighbours, "GROUPS", 60)
    got, expected = _run(spark, rows), _brute(rows)
    assert sum((got & expected).values()) >= 0.97 * len(rows)
    monkeypatch.setattr(neighbours, "RECALL", 2.0)  # none is good enough
    monkeypatch.setattr(neighbours, "AUDITS", 1)
    assert _run(spark, rows) == expected


def test_odd_vectors(spark):
    x, y = [1.0, 2.0, 3.0], [2.0, 4.0, 6.0]
    rows = [(1, x), (2, y), (3, x), (3, x), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 2.0]), (8, [float("nan"), 1.0, 1.0]), (9, [float("inf"), 1.0, 1.0]), (10, [-1.0, -2.0, -3.0]), (11, [1e-30, 2e-30, 3e-30]), (12, [1.0, 2.0])]
    assert _run(spark, rows) == _brute(rows)
    assert _run(spark, []) == Counter()
