"""Toxicity by a bidirectional gated recurrent network with attention pooling, over word and character inputs.

A word's input is an embedding of the word (hashed) beside the mean embedding of its character n-grams (hashed), so that
unseen forms of a word are still known by their parts. Two gated recurrent networks read a window of ``WINDOW`` words in
either direction, attention weighs the positions, and a linear unit scores the pooled state. All overlapping windows of a
text are scored, ``STRIDE`` words apart; the text's score is that of its highest window, calibrated with the number of
windows.

The network is trained here, in numpy, on a bounded sample of labelled documents: SAMPLE of each label, by a hash of the id.
As labels are of documents, each document teaches by its highest window and by others at random, chosen anew in each turn
by the network itself (at first by the log-odds that the embeddings begin with). A part of the sample is kept back for the
calibration, which restores the labels' shares.

Edge cases: words are runs of letters, marks and digits in lower case; null texts and those without a word get score 0;
without documents of both labels every score is the share of toxic ones; repeated labels of a document count as toxic if one
does; every row of a repeated doc_id is scored by itself; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import slices
from tabflow.llm.langid import held_out

#: Labelled documents of each label that the network is trained and calibrated on, at most.
SAMPLE = 2000
WINDOW, STRIDE = 32, 16
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 8, 8, 8, 8
WORD_ROWS, CHAR_ROWS = 1 << 15, 1 << 17
CHAR_ORDERS = (3, 4, 5)
TURNS, EPOCHS, BATCH, RATE = 2, 4, 256, 0.01
#: Share of words that are shown by their characters alone while training.
HIDE = 0.5
#: Steps of a turn at least, for small samples.
STEPS = 120
#: Documents that a word's prior log-odds are shrunk by.
SHRINK = 20.0
#: Words whose inputs are made at a time.
WORDS = 20_000
#: Windows that are scored at a time.
CHUNK = 2048
_MIX = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier


def _words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, which one each word of the texts is, and the number of words of each text."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}\p{M}\p{N}]+")
    coded = pc.dictionary_encode(lists.flatten())
    which, where, distinct = np.asarray(coded.indices), np.asarray(pc.list_parent_indices(lists)), coded.dictionary.to_pylist()
    if "" in distinct:
        keep = which != distinct.index("")
        which, where = which[keep], where[keep]
    return distinct, which, np.bincount(where, minlength=len(texts))


class Inputs:
    """Hashed inputs of distinct words: a row of the word table, and rows of the character table."""

    def __init__(self, words: list[str]):
        parts = [self._hashed(words[i : i + WORDS]) for i in range(0, len(words), WORDS)] or [self._hashed([])]
        self.word, self.char, self.n = (np.concatenate([p[k] for p in parts]) for k in range(3))
        self.of = np.repeat(np.arange(len(words), dtype=np.int32), self.n)

    @staticmethod
    def _hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the words, of their n-grams in the words' order, and how many n-grams each has."""
        codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        sizes = np.array([len(w) + 2 for w in words], np.int64)
        begin = np.cumsum(sizes) - sizes
        whole = np.zeros(len(words), np.uint64)
        for k in range(int(sizes.max(initial=0))):
            on = np.flatnonzero(sizes > k)
            whole[on] = (whole[on] ^ codes[begin[on] + k]) * _MIX
            whole[on] ^= whole[on] >> np.uint64(29)
        rows, of = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        for n in CHAR_ORDERS:
            if len(codes) < n:
                continue
            h = np.zeros(len(codes) - n + 1, np.uint64)
            for k in range(n):
                h = (h ^ codes[k : k + len(h)]) * _MIX
                h ^= h >> np.uint64(29)
            inside = owner[: len(h)] == owner[n - 1 :]
            rows.append((h[inside] % np.uint64(CHAR_ROWS)).astype(np.int32))
            of.append(owner[: len(h)][inside])
        rows, of = np.concatenate(rows), np.concatenate(of)
        return (whole % np.uint64(WORD_ROWS)).astype(np.int32), rows[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(words))

    def take(self, words: np.ndarray) -> "Inputs":
        """The inputs of some of the words."""
        out = object.__new__(Inputs)
        n = self.n[words]
        begin = (np.cumsum(self.n) - self.n)[words] if len(words) else n
        out.word, out.n, out.of = self.word[words], n, np.repeat(np.arange(len(words)), n)
        out.char = self.char[np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())]
        return out

    def vectors(self, p: dict[str, np.ndarray]) -> np.ndarray:
        mean = np.zeros((len(self.word), CHAR_DIM), p["chars"].dtype)
        end = np.cumsum(self.n)
        for i in range(0, len(self.word), WORDS):
            n = self.n[i : i + WORDS]
            some = np.flatnonzero(n)
            if len(some):
                base = end[i] - n[0]
                own = p["chars"][self.char[base : end[min(i + WORDS, len(end)) - 1]]]
                mean[i + some] = np.add.reduceat(own, (end[i : i + WORDS] - n)[some] - base) / n[some, None]
        return np.concatenate([p["words"][self.word], mean], axis=1)


def _windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The document, first word (within all words) and length of every window."""
    n = np.where(counts == 0, 0, np.maximum(0, -(-(counts - WINDOW) // STRIDE)) + 1)
    doc = np.repeat(np.arange(len(counts)), n)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = (np.cumsum(counts) - counts)[doc] + nth * STRIDE
    return doc, first, np.minimum(WINDOW, counts[doc] - nth * STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _read(gates: np.ndarray, mask: np.ndarray, u: np.ndarray, backwards: bool, trace: list | None = None) -> np.ndarray:
    """States of one direction: gates (steps, windows, 3 * HIDDEN) are the inputs' part of the gates."""
    steps, n, _ = gates.shape
    h, out = np.zeros((n, HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32)
    for t in reversed(range(steps)) if backwards else range(steps):
        g, gh, m = gates[t], h @ u, mask[t]
        zr = _sigmoid(g[:, : 2 * HIDDEN] + gh[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(g[:, 2 * HIDDEN :] + r * gh[:, 2 * HIDDEN :])
        new = h + m * (1 - z) * (c - h)
        if trace is not None:
            trace.append((t, h, z, r, c, gh[:, 2 * HIDDEN :]))
        out[t] = h = new
    return out


def _unread(dout: np.ndarray, mask: np.ndarray, u: np.ndarray, trace: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates and of u."""
    dgates = np.zeros((*dout.shape[:2], 3 * HIDDEN), np.float32)
    du, dh = np.zeros_like(u), np.zeros(dout.shape[1:], np.float32)
    for t, h, z, r, c, gh in reversed(trace):
        dh = dh + dout[t]
        d = dh * mask[t]
        dc = d * (1 - z) * (1 - c * c)
        dz = d * (h - c) * z * (1 - z)
        dr = dc * gh * r * (1 - r)
        dgates[t] = np.concatenate([dz, dr, dc], 1)
        dgh = np.concatenate([dz, dr, dc * r], 1)
        du += h.T @ dgh
        dh = dh * (1 - mask[t]) + d * z + dgh @ u.T
    return dgates, du


class Network:
    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        normal = lambda *s, scale=0.1: rng.normal(0, scale, s).astype(np.float32)
        d = WORD_DIM + CHAR_DIM
        self.p = {
            "words": normal(WORD_ROWS, WORD_DIM, scale=0.02), "chars": normal(CHAR_ROWS, CHAR_DIM, scale=0.02),
            "wf": normal(d, 3 * HIDDEN, scale=0.3), "wb": normal(d, 3 * HIDDEN, scale=0.3), "bf": normal(3 * HIDDEN), "bb": normal(3 * HIDDEN),
            "uf": normal(HIDDEN, 3 * HIDDEN, scale=0.3), "ub": normal(HIDDEN, 3 * HIDDEN, scale=0.3),
            "wa": normal(2 * HIDDEN, ATTEND, scale=0.3), "va": normal(ATTEND, scale=0.3), "wo": normal(2 * HIDDEN, scale=0.3), "bo": np.zeros(1, np.float32)}

    def _forward(self, gf, gb, mask, tf=None, tb=None):
        p = self.p
        h = np.concatenate([_read(gf, mask, p["uf"], False, tf), _read(gb, mask, p["ub"], True, tb)], axis=2)
        a = np.tanh(h @ p["wa"])
        e = np.where(mask[..., 0] > 0, a @ p["va"], np.float32(-1e9))
        e = np.exp(e - e.max(axis=0))
        w = e / e.sum(axis=0)
        pooled = np.einsum("tn,tnd->nd", w, h)
        return pooled @ p["wo"] + p["bo"][0], (h, a, w, pooled)

    def logits(self, x: np.ndarray, which: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Scores of windows; x: inputs of distinct words, which: the words in turn."""
        p = self.p
        gf = np.concatenate([x @ p["wf"] + p["bf"], np.zeros((1, 3 * HIDDEN), np.float32)])  # a distinct word's gates, once
        gb = np.concatenate([x @ p["wb"] + p["bb"], np.zeros((1, 3 * HIDDEN), np.float32)])
        out = np.empty(len(first), np.float32)
        for i in range(0, len(first), CHUNK):
            at, mask = self._places(which, first[i : i + CHUNK], length[i : i + CHUNK], len(x))
            out[i : i + CHUNK] = self._forward(gf[at], gb[at], mask)[0]
        return out

    @staticmethod
    def _places(which, first, length, none):
        steps = np.arange(int(length.max(initial=1)))[:, None]
        on = steps < length
        at = np.where(on, which[np.minimum(first + steps, len(which) - 1)], none)
        return at, on[..., None].astype(np.float32)

    def gradients(self, inputs: Inputs, at, mask, label, hide: np.ndarray | None = None) -> dict:
        """Gradients of the mean log-loss of windows; at: the word at each step, (steps, windows). Those of the tables come
        as rows and their gradients. Words in ``hide`` are known by their characters alone."""
        p = self.p
        x = inputs.vectors(p)
        if hide is not None:
            x[hide, :WORD_DIM] = 0
        x = x[at]
        tf, tb = [], []
        logit, (h, a, w, pooled) = self._forward(x @ p["wf"] + p["bf"], x @ p["wb"] + p["bb"], mask, tf, tb)
        d = ((_sigmoid(logit) - label) / len(label)).astype(np.float32)
        g = {"wo": pooled.T @ d, "bo": d.sum(keepdims=True)}
        dpooled = d[:, None] * p["wo"]
        dw = np.einsum("nd,tnd->tn", dpooled, h)
        de = w * (dw - (w * dw).sum(axis=0))
        da = de[..., None] * p["va"] * (1 - a * a)
        g["va"] = np.einsum("tn,tna->a", de, a)
        g["wa"] = np.einsum("tnd,tna->da", h, da)
        dh = w[..., None] * dpooled + da @ p["wa"].T
        dx = 0
        for side, part, trace in (("f", dh[..., :HIDDEN], tf), ("b", dh[..., HIDDEN:], tb)):
            dg, g[f"u{side}"] = _unread(part, mask, p[f"u{side}"], trace)
            dg *= mask
            g[f"w{side}"], g[f"b{side}"] = np.einsum("tnd,tng->dg", x, dg), dg.sum(axis=(0, 1))
            dx = dx + dg @ p[f"w{side}"].T
        distinct = np.zeros((len(inputs.word), dx.shape[2]), np.float32)
        np.add.at(distinct, at.ravel(), (dx * mask).reshape(-1, dx.shape[2]))
        shown = np.ones(len(inputs.word), bool) if hide is None else ~hide
        g["words"] = (inputs.word[shown], distinct[shown, :WORD_DIM])
        g["chars"] = (inputs.char, distinct[inputs.of, WORD_DIM:] / inputs.n[inputs.of, None])
        return g

    def train(self, inputs: Inputs, which, first, length, label, rng, state: dict) -> None:
        for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(label)))):
            order = rng.permutation(len(label))
            for i in range(0, len(order), BATCH):
                own = order[i : i + BATCH]
                state["t"] = state.get("t", 0) + 1
                at, mask = self._places(which, first[own], length[own], 0)
                words, back = np.unique(at, return_inverse=True)
                for k, g in self.gradients(inputs.take(words), back.reshape(at.shape), mask, label[own], rng.random(len(words)) < HIDE).items():
                    if isinstance(g, tuple):  # rows of a table: a step for each row that was used
                        rows, back = np.unique(g[0], return_inverse=True)
                        total = np.zeros((len(rows), g[1].shape[1]), np.float32)
                        np.add.at(total, back, g[1])
                        s = state.setdefault(k, np.zeros(len(self.p[k]), np.float32))
                        s[rows] += (total**2).mean(axis=1)
                        self.p[k][rows] -= 5 * RATE * total / np.sqrt(s[rows, None] + 1e-10)
                    else:
                        m, v = state.setdefault(k, (np.zeros_like(g), np.zeros_like(g)))
                        m[...] = 0.9 * m + 0.1 * g
                        v[...] = 0.999 * v + 0.001 * g * g
                        t = state["t"]
                        self.p[k] -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    def begin(self, inputs: Inputs, which, counts, label) -> None:
        """The first column of both tables begins as the shrunk log-odds of documents with the row."""
        share, edge = label.mean(), np.cumsum([0, *counts])
        start = np.cumsum(inputs.n) - inputs.n
        toxic = {k: np.zeros(len(self.p[k])) for k in ("words", "chars")}
        every = {k: np.zeros(len(self.p[k])) for k in ("words", "chars")}
        for y, a, b in zip(label, edge, edge[1:]):
            word = np.unique(which[a:b])
            n = inputs.n[word]
            char = inputs.char[np.repeat(start[word] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            for k, rows in (("words", inputs.word[word]), ("chars", char)):
                rows = np.unique(rows)
                every[k][rows] += 1
                toxic[k][rows] += y
        for k in toxic:
            p = (toxic[k] + SHRINK * share) / (every[k] + SHRINK)
            self.p[k][:, 0] = np.log(p / (1 - p)) - np.log(share / (1 - share))


def _highest(logit: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's highest window and its score; -1 and -inf without one."""
    order = np.lexsort((-logit, doc))
    first = np.ones(len(order), bool)
    first[1:] = doc[order][1:] != doc[order][:-1]
    best, score = np.full(n, -1), np.full(n, -np.inf)
    best[doc[order][first]], score[doc[order][first]] = order[first], logit[order][first]
    return best, score


def _calibrate(score: np.ndarray, windows: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of (1, highest score, log of windows): logistic regression with a small ridge, by Newton's steps that are
    halved until they help."""
    x = np.stack([np.ones(len(score)), score, np.log(windows)], 1)
    ridge = np.array([1e-3, 0.05, 0.05])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(weight @ (np.logaddexp(0, z) - label * z) + 0.5 * ridge @ b**2)

    b = np.array([0.0, 1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ b)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (weight * (p - label)) + ridge * b)
        size = 1.0
        while size > 1e-4 and loss(b - size * step) > loss(b):
            size /= 2
        b = b - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return b


class Scorer:
    """A trained and calibrated network."""

    def __init__(self, texts: list[str], label: np.ndarray, share: float, seed: int = 0):
        self.share, self.net = share, None
        if not 0 < label.sum() < len(label):
            return
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(texts))
        cut = max(1, len(texts) // 4)
        kept, own = order[:cut], order[cut:]
        if len(set(label[own])) < 2 or len(set(label[kept])) < 2:
            kept = own = order
        self.net, state = Network(seed), {}
        distinct, which, counts = _words(pa.array([texts[i] for i in own], pa.string()))
        y = label[own].astype(np.float32)
        inputs = Inputs(distinct)
        self.net.begin(inputs, which, counts, y)
        doc, first, length = _windows(counts)
        prior = self.net.p["words"][inputs.word, 0] + 5 * inputs.vectors(self.net.p)[:, WORD_DIM]
        at, mask = Network._places(which, first, length, 0)
        logit = (prior[at] * mask[..., 0]).max(axis=0)
        for _ in range(TURNS):
            best, _ = _highest(logit, doc, len(y))
            # of toxic documents the highest window teaches, of others that one and some at random
            some = rng.choice(len(doc), min(len(doc), len(y)), replace=False)
            pick = np.unique(np.concatenate([best[best >= 0], some[y[doc[some]] == 0]]))
            self.net.train(inputs, which, first[pick], length[pick], y[doc[pick]], rng, state)
            logit = self.net.logits(inputs.vectors(self.net.p), which, first, length)
        score, windows = self.highest(pa.array([texts[i] for i in kept], pa.string()))
        has, y = windows > 0, label[kept].astype(float)
        weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
        self.b = _calibrate(score[has], windows[has], y[has], weight[has])

    def highest(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        distinct, which, counts = _words(texts)
        doc, first, length = _windows(counts)
        if not len(doc):
            return np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)
        logit = self.net.logits(Inputs(distinct).vectors(self.net.p), which, first, length)
        return _highest(logit, doc, len(texts))[1], np.bincount(doc, minlength=len(texts))

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.share)
        score, windows = self.highest(texts)
        has = windows > 0
        out = np.zeros(len(texts))
        z = self.b[0] + self.b[1] * score[has] + self.b[2] * np.log(windows[has])
        out[has] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Train on rows that are not held out: at most ``sample`` documents of each label come to the driver."""
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("_toxic"))
    share = own.agg(F.avg("_toxic")).first()[0]
    if share is None:
        return Scorer([], np.empty(0), 0.0)
    order = F.xxhash64("_id")
    chosen = own.where("_toxic = 1").orderBy(order, "_id").limit(sample).unionByName(own.where("_toxic = 0").orderBy(order, "_id").limit(sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(chosen), "_id").toPandas()
    rows = rows.sort_values(["_id", "text"]).drop_duplicates("_id")
    return Scorer(rows["text"].where(rows["text"].notna(), None).tolist(), rows["_toxic"].to_numpy(float), float(share))


def score(spark: SparkSession, docs: DataFrame, scorer: Scorer, keep: list[str] = ["doc_id"]) -> DataFrame:  # noqa: B006
    """The kept columns of docs with the score of the whole text."""
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col("text").alias("_text"))
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    handed = spark.sparkContext.broadcast(scorer)  # of a fixed size

    def run(batches):
        for batch in slices(batches, "_text", 2 << 20):
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(handed.value.scores(batch.column("_text")))], names=[*names, "score"])

    return rows.mapInArrow(run, f"{types}, score double").select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "score")


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.5 on) for every row of docs."""
    scored = score(spark, docs, fit(spark, docs, labels, sample))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
