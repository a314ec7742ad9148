"""Language identification by interpolated Kneser-Ney character models.

Every language has a model of order ``ORDER`` over the characters of its words, a word being a maximal run of letters in
lower case with a blank on either side. N-grams of the highest order are counted over all labelled training documents;
lower orders are continuation counts of these. The models are kept together as sorted arrays of 64-bit hashes, one for each
order, with a row of log-probabilities or back-off weights per hash, and found by binary search.

A document's cross-entropy under a model is the mean of -log2 p over its characters; the lowest one decides. The prediction
is rejected where that cross-entropy is far above the median of the language's training documents: by ``SPREADS`` times the
distance to their 90 % quantile, ``LEAST_MARGIN`` bits at least, and ``SHORT`` bits over the root of the text's characters,
as a mean over few characters varies more. A tenth of the labels may be noise without moving the limit much.

Edge cases: null texts and texts without a letter get ``und``, score 0 and are rejected; null languages are not learned;
without a labelled document every prediction is ``und``; equal cross-entropies go to the first language in alphabetical
order; every row of a repeated doc_id is scored by itself; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import frugal, materialise, ship, slices

ORDER = 4
FOLDS = 5
#: Distinct n-grams, added up over languages, that the driver and workers hold at a time. Beyond, the languages are scored in
#: groups, one after the other, to the same result; a language is never cut (alphabetic ones have some hundred thousand).
MAX_GRAMS = 4_000_000
#: The rejection's limit in bits above the median (see above).
SPREADS, LEAST_MARGIN, SHORT = 6.0, 2.5, 5.0
_MIX = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text is divisible by FOLDS."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of some texts, and for each word in turn which one it is and in which text it is."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}\p{M}]+")
    coded = pc.dictionary_encode(lists.flatten())
    where = np.asarray(pc.list_parent_indices(lists))
    which = np.asarray(coded.indices)
    distinct = coded.dictionary.to_pylist()
    if "" in distinct:
        keep = which != distinct.index("")
        which, where = which[keep], where[keep]
    return distinct, which, where


def _grams(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of " " * (order - 1) + word + " " for each word: code points (n, order), and the word each is of."""
    pad = " " * (order - 1)
    codes = np.frombuffer("".join(pad + w + " " for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(w) + 1 for w in words], np.int64)  # n-grams, one for each character and the blank after them
    of = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(of)) + of * (order - 1)
    return codes[at[:, None] + np.arange(order)], of


def _hashes(grams: np.ndarray) -> np.ndarray:
    """64-bit hashes of the rows; a hash of the last n - 1 columns does not depend on the first."""
    h = np.zeros(len(grams), np.uint64)
    for k in range(grams.shape[1]):
        h = (h ^ grams[:, k].astype(np.uint64)) * _MIX
        h ^= h >> np.uint64(29)
    return h


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram, n: how often each n-gram occurs in docs (text, lang); summed in each task before the shuffle."""
    def count(batches):
        total: dict[tuple[str, str], int] = {}
        for batch in slices(batches, "text"):
            langs = batch.column("lang")
            for lang in pc.unique(langs).to_pylist():
                distinct, which, _ = _words(batch.column("text").filter(pc.equal(langs, lang)))
                times = np.bincount(which, minlength=len(distinct))
                if not len(distinct) or not times.any():
                    continue
                grams, of = _grams(distinct, order)
                hashes, first, back = np.unique(_hashes(grams), return_index=True, return_inverse=True)
                sums = np.bincount(back, weights=times[of])
                texts = grams[first].tobytes().decode("utf-32-le", "surrogatepass")
                for k, n in enumerate(sums.astype(np.int64).tolist()):
                    if n:
                        key = (lang, texts[k * order : k * order + order])
                        total[key] = total.get(key, 0) + n
        items = list(total.items())
        for i in range(0, len(items), 50_000):
            part = items[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in part]), pa.array([k[1] for k, _ in part]), pa.array([n for _, n in part], pa.int64())], names=["lang", "gram", "n"])

    rows = docs.select("text", F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return rows.mapInArrow(frugal(count), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _groups(counts: DataFrame) -> list[list[str]]:
    """Languages in alphabetical order, in groups of at most MAX_GRAMS n-grams (or one language)."""
    groups, room = [], 0
    for r in sorted(counts.groupBy("lang").count().collect()):  # a row per language
        if not groups or r["count"] > room:
            groups.append([])
            room = MAX_GRAMS
        groups[-1].append(r["lang"])
        room -= r["count"]
    return groups


def fit(spark: SparkSession, docs: DataFrame, order: int = ORDER) -> "Model":
    """One model of all of docs' languages (text, lang), held by the driver; ``identify`` makes them in groups."""
    return Model(materialise(spark, count_grams(docs, order), "grams").toPandas(), order)


class Model:
    """Kneser-Ney models of all languages, as arrays.

    tables[k], for orders k = 1 to order: sorted hashes of k-grams seen in any language, and log2 p of the last character
    given those before it, a column per language. backs[k]: sorted hashes of contexts of k characters and log2 of the
    weight that the next lower order gets there (0 where a language has not seen the context)."""

    def __init__(self, counts: pd.DataFrame, order: int, alphabet: int | None = None):
        self.order, self.langs = order, sorted(counts["lang"].unique())
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.backs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.unseen = np.zeros(max(1, len(self.langs)), np.float32)
        if not self.langs:
            return
        grams = np.frombuffer("".join(counts["gram"]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, order)
        n, lang = counts["n"].to_numpy(float), np.searchsorted(self.langs, counts["lang"])
        levels = {order: [(grams[lang == j], n[lang == j]) for j in range(len(self.langs))]}
        for k in range(order - 1, 0, -1):  # continuation counts: of each k-gram, the distinct characters before it
            levels[k] = [self._suffixes(g) for g, _ in levels[k + 1]]
        alphabet = alphabet or len(np.unique(grams)) + 1
        self.unseen[:] = -np.log2(alphabet)
        for k in range(1, order + 1):
            hashes = np.unique(np.concatenate([_hashes(g) for g, _ in levels[k]]))
            every = np.empty((len(hashes), k), np.uint32)
            for g, _ in levels[k]:
                every[np.searchsorted(hashes, _hashes(g))] = g
            below = self._lookup(k - 1, every[:, 1:])  # log2 p of the next lower order, a column per language
            contexts = _hashes(every[:, :-1])
            known = np.unique(contexts)
            at, own = np.searchsorted(known, contexts), np.empty((len(hashes), len(self.langs)), np.float32)
            back = np.zeros((len(known), len(self.langs)), np.float32)
            for j, (g, c) in enumerate(levels[k]):
                once, twice = (c == 1).sum(), (c == 2).sum()
                d = once / (once + 2 * twice) if once and twice else 0.5
                place = np.searchsorted(known, _hashes(g[:, :-1]))
                total, kinds = np.bincount(place, c, len(known)), np.bincount(place, minlength=len(known))
                seen = total > 0
                weight = np.where(seen, d * kinds / np.where(seen, total, 1), 1.0)
                p = weight[at] * np.exp2(below[:, j])
                p[np.searchsorted(hashes, _hashes(g))] += np.maximum(c - d, 0) / total[place]
                own[:, j], back[:, j] = np.log2(p), np.log2(weight)
            self.tables[k], self.backs[k - 1] = (hashes, own), (known, back)

    @staticmethod
    def _suffixes(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest = np.ascontiguousarray(grams[:, 1:])
        _, first, n = np.unique(_hashes(rest), return_index=True, return_counts=True)
        return rest[first], n.astype(float)

    def _lookup(self, k: int, grams: np.ndarray) -> np.ndarray:
        """log2 p of each k-gram's last character under every language; unseen n-grams back off."""
        if k == 0:
            return np.broadcast_to(self.unseen, (len(grams), len(self.langs)))
        hashes, own = self.tables[k]
        wanted = _hashes(grams)
        at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
        out = own[at]
        missing = np.flatnonzero(hashes[at] != wanted)
        if len(missing):
            known, back = self.backs[k - 1]
            contexts = _hashes(grams[missing, :-1])
            place = np.minimum(np.searchsorted(known, contexts), len(known) - 1)
            weight = np.where((known[place] == contexts)[:, None], back[place], 0)
            out[missing] = weight + self._lookup(k - 1, grams[missing, 1:])
        return out

    def cross_entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text under each language, and its scored characters."""
        total, chars = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        distinct, which, where = _words(texts)
        if len(which) and self.langs:
            grams, of = _grams(distinct, self.order)
            scores = np.empty((len(grams), len(self.langs)), np.float32)
            for i in range(0, len(grams), 1 << 18):
                scores[i : i + (1 << 18)] = self._lookup(self.order, grams[i : i + (1 << 18)])
            sizes = np.bincount(of, minlength=len(distinct))
            sums = np.add.reduceat(scores, np.cumsum(sizes) - sizes).astype(float)
            for j in range(len(self.langs)):
                total[:, j] = np.bincount(where, sums[which, j], len(texts))
        if len(which):
            chars = np.bincount(where, np.array([len(w) + 1 for w in distinct])[which], len(texts)).astype(np.int64)
        return -total / np.maximum(chars, 1)[:, None], chars


def _lettered(texts: pa.Array) -> np.ndarray:
    """Which texts have a letter; marks alone are no language."""
    return np.asarray(pc.match_substring_regex(pc.fill_null(texts, ""), r"\p{L}").to_numpy(zero_copy_only=False), bool)


def score(docs: DataFrame, model: "Model", keep: list[str]) -> DataFrame:
    """The kept columns with lang_pred, score, bits (per character under the predicted language) and chars.

    The score is the predicted language's share of the likelihoods of 20 characters at the text's cross-entropies."""
    handed = docs.sparkSession.sparkContext.broadcast(model)  # a group of at most MAX_GRAMS n-grams
    rows = docs.select(*keep, F.col("text").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema) + ", lang_pred string, score double, bits double, chars long"

    def predict(batches):
        m = handed.value
        langs = np.array([*m.langs, "und"], object)
        for batch in slices(batches, "_text"):
            bits, chars = m.cross_entropies(batch.column("_text"))
            if m.langs:
                best = bits.argmin(axis=1)
                low = bits[np.arange(len(bits)), best]
                share = 1 / np.exp2(-20 * (bits - low[:, None])).sum(axis=1)
            else:
                best, low, share, chars = np.zeros(len(chars), int), np.zeros(len(chars)), np.zeros(len(chars)), chars * 0
            none = (chars == 0) | ~_lettered(batch.column("_text"))
            pred = np.where(none, "und", langs[best])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(pred, pa.string()), pa.array(np.where(none, 0.0, share)), pa.array(np.where(none, 0.0, low)), pa.array(np.where(none, 0, chars))], names=[*keep, "lang_pred", "score", "bits", "chars"])

    return rows.mapInArrow(frugal(predict), schema)


def _score_in_groups(spark: SparkSession, docs: DataFrame, counts: DataFrame, groups: list[list[str]], order: int, keep: list[str]) -> DataFrame:
    """As score, with the models of one group of languages at a time: a scan for each, joined by the rows' numbers."""
    characters = F.explode(F.array(*[F.substring("gram", k + 1, 1) for k in range(order)]))
    alphabet = counts.select(characters.alias("c")).distinct().count() + 1
    numbered, every = docs.withColumn("_row", F.monotonically_increasing_id()), None
    for group in groups:
        handed = spark.sparkContext.broadcast(Model(counts.where(F.col("lang").isin(group)).toPandas(), order, alphabet))

        def measure(batches, handed=handed):
            for batch in slices(batches, "text"):
                bits, chars = handed.value.cross_entropies(batch.column("text"))
                chars = np.where(_lettered(batch.column("text")), chars, 0)
                yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(list(bits), pa.list_(pa.float64())), pa.array(chars)], names=["_row", "_bits", "chars"])

        part = materialise(spark, numbered.select("_row", "text").mapInArrow(frugal(measure), "_row long, _bits array<double>, chars long"), "bits")
        handed.unpersist()
        every = part if every is None else every.join(part.select("_row", F.col("_bits").alias("_more")), "_row").select("_row", F.concat("_bits", "_more").alias("_bits"), "chars")
    low, langs, some = F.array_min("_bits"), F.array(*[F.lit(x) for g in groups for x in g]), F.col("chars") > 0
    share = 1 / F.aggregate("_bits", F.lit(0.0), lambda t, b: t + F.pow(F.lit(2.0), -20 * (b - low)))
    best = F.element_at(langs, F.array_position("_bits", low).cast("int"))
    return numbered.select("_row", *keep).join(every, "_row").select(
        *keep, F.when(some, best).otherwise("und").alias("lang_pred"), F.when(some, share).otherwise(0.0).alias("score"), F.when(some, low).otherwise(0.0).alias("bits"), "chars")


def identify(spark: SparkSession, docs: DataFrame, keep: list[str] = ["doc_id"], order: int = ORDER) -> DataFrame:  # noqa: B006
    """Learn from the rows of docs (doc_id, text, lang) that are not held out and predict all: the kept columns, held_out,
    lang_pred, score, bits, chars and rejected."""
    ship(spark)
    counts = materialise(spark, count_grams(docs.where(~held_out(F.col("doc_id"))), order), "grams")
    groups = _groups(counts)
    names = [f"_k{i}" for i in range(len(keep))]
    own = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], held_out(F.col("doc_id")).alias("_held"), F.col("lang").isNotNull().alias("_labelled"), "text")
    kept = [*names, "_held", "_labelled"]
    found = score(own, Model(counts.toPandas(), order), kept) if len(groups) < 2 else _score_in_groups(spark, own, counts, groups, order, kept)
    scored = materialise(spark, found, "languages")
    q = F.percentile_approx("bits", [0.5, 0.9], 10_000)
    limits = scored.where(~F.col("_held") & F.col("_labelled") & (F.col("lang_pred") != "und")).groupBy("lang_pred").agg(q.alias("_q"))
    limits = limits.select("lang_pred", (F.col("_q")[0] + F.greatest(SPREADS * (F.col("_q")[1] - F.col("_q")[0]), F.lit(LEAST_MARGIN))).alias("_limit"))
    out = scored.join(F.broadcast(limits), "lang_pred", "left")  # a row per language
    rejected = (F.col("lang_pred") == "und") | F.coalesce(F.col("bits") > F.col("_limit") + SHORT / F.sqrt("chars"), F.lit(False))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("_held").alias("held_out"), "lang_pred", "score", "bits", "chars", rejected.alias("rejected"))
