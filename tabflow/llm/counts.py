"""Token counts of whole texts without token ids.

A tokenizer's model works on pre-tokens, each by itself. So the number of tokens of a text is the sum, over its distinct
pre-tokens, of their frequency times the pre-token's number of pieces:

* one pass gathers the distinct pre-tokens of all documents with their frequencies;
* the model counts the pieces of each of them once;
* a second pass takes each document's pre-token frequencies. The pre-tokens that are frequent in the corpus, at most
  BROADCAST, are summed there from a broadcast list. All others go with their document's number to a join by pre-token.

The pre-tokens are those of the library's own normalizer and pre-tokenizer. Where these drop white space and never look
across it, they are made once for each distinct word, as a word between blanks has the same ones everywhere, and words of
ASCII letters with at most a mark at the end need no call of the library.
Special strings in a text are taken as the library does by default: each is one token and ends the text before it.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import materialise_at, ship, slices

#: Frequent pre-tokens that are broadcast, 64 bytes each at most; the rest is joined by a shuffle, to the same result.
BROADCAST = 200_000
#: Words and bytes of words a worker keeps; when it has more, it starts anew. It changes no result.
CACHE_WORDS, CACHE_BYTES = 400_000, 32 << 20
#: Bytes of texts that are worked on at a time.
SLICE_BYTES = 6 << 20
#: Longer pre-tokens are known by a 128-bit digest.
KEY_BYTES = 48
LIMIT = 2048
#: Fixed value: the pattern of pre-tokens that vocabularies with word ends use.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = r"^(?P<core>[A-Za-z]+)(?P<tail>[,.;:!?]*)$"  # words of one or two pre-tokens that need no library
_SPECIAL, _DIGEST = "\x01", "\x00"

_held: dict[str, "PreTokens"] = {}


def pre_tokens(path: str) -> "PreTokens":
    """The worker's pre-tokens for a vocabulary file; kept between tasks."""
    if path not in _held:
        _held[path] = PreTokens(path)
    return _held[path]


def _keeps_to_words(spec: dict) -> bool:
    """Whether the vocabulary's normalizer and pre-tokenizer are those that WORD_PATTERN is known for: none of them looks
    across white space, which is dropped; a run of letters is one pre-token, and so is a run of other characters that are
    neither letters nor digits, where no apostrophe is near."""
    norm, split = spec.get("normalizer"), spec.get("pre_tokenizer")
    steps = norm["normalizers"] if norm and norm["type"] == "Sequence" else [norm] if norm else []
    spaces = lambda s: s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " "
    plain = all(s["type"] in ("NFC", "Lowercase") or spaces(s) for s in steps) and any(s["type"] == "Lowercase" for s in steps)
    first, *others = split["pretokenizers"] if split["type"] == "Sequence" else [split]
    words = first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"] and first["pattern"] == {"Regex": WORD_PATTERN}
    return plain and words and all(s["type"] == "ByteLevel" and not s["use_regex"] and not s["add_prefix_space"] for s in others)


class PreTokens:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        spec = json.loads(self.lib.to_str())
        if not spec.get("pre_tokenizer"):
            raise ValueError(f"{path} has no pre-tokenizer: its model works on whole texts")
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError(f"{path} has added tokens that depend on the text around them")
        longest = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if added else None
        self.by_word = _keeps_to_words(spec)
        self.reset()

    def reset(self) -> None:
        self.slots: dict[str, int] = {}  # word that is not plain: its place in edge
        self.edge, self.pool, self.bytes = [0], [], 0
        self.keys: list[str] = []  # pre-token number: key
        self.texts: dict[int, str] = {}  # the pre-token of a number whose key is a digest
        self.numbers: dict[str, int] = {}

    def full(self) -> bool:
        return max(len(self.slots), len(self.keys)) > CACHE_WORDS or self.bytes > CACHE_BYTES

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text, special strings marked."""
        out = []
        for i, part in enumerate(self.special.split(text) if self.special else [text]):
            if i % 2:
                out.append(_SPECIAL + part)
            elif part:
                norm = self.lib.normalizer.normalize_str(part) if self.lib.normalizer else part
                out += [t for t, _ in self.lib.pre_tokenizer.pre_tokenize_str(norm)]
        return out

    def pieces(self, token: str) -> int:
        return 1 if token.startswith(_SPECIAL) else len(self.lib.model.tokenize(token))

    def _number(self, token: str) -> int:
        n = self.numbers.get(token)
        if n is not None:
            return n
        raw = token.encode()
        key = token if len(raw) <= KEY_BYTES else _DIGEST + xxhash.xxh128_hexdigest(raw)
        n = self.numbers.get(key)
        if n is None:
            n = self.numbers[key] = len(self.keys)
            self.keys.append(key)
            self.bytes += len(raw)
            if key is not token:
                self.texts[n] = token
        return n

    def _numbers(self, tokens: pa.Array) -> np.ndarray:
        coded = pc.dictionary_encode(tokens)
        distinct = coded.dictionary.to_pylist()
        found = list(map(self.numbers.get, distinct))
        if None in found:
            found = [self._number(t) if n is None else n for t, n in zip(distinct, found)]
        return np.array(found, np.int64)[np.asarray(coded.indices)] if len(distinct) else np.empty(0, np.int64)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For every pre-token of the texts: the text's place, and the pre-token's number in keys."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            found = [[self._number(t) for t in self.split(x)] for x in texts.to_pylist()]
            return np.repeat(np.arange(len(found)), [len(f) for f in found]), np.array([n for f in found for n in f], np.int64)
        lists = pc.ascii_split_whitespace(texts)
        coded, parents = pc.dictionary_encode(lists.flatten()), np.asarray(pc.list_parent_indices(lists))
        words = coded.dictionary
        if not len(words):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        shape = pc.extract_regex(words, _PLAIN)
        plain = pc.is_valid(shape)
        easy = shape.filter(plain)
        core = self._numbers(pc.ascii_lower(pc.struct_field(easy, "core")))
        tails = pc.struct_field(easy, "tail")
        marked = np.asarray(pc.not_equal(tails, "").to_numpy(zero_copy_only=False), bool)
        tail = np.zeros(len(core), np.int64)
        tail[marked] = self._numbers(tails.filter(pa.array(marked)))
        hard = words.filter(pc.invert(plain)).to_pylist()
        for w in hard:
            if w not in self.slots:
                self.pool += [self._number(t) for t in self.split(w)]
                self.slots[w] = len(self.edge) - 1
                self.edge.append(len(self.pool))
                self.bytes += len(w)
        # where each distinct word's pre-tokens begin, and how many they are: plain words first, two places each
        where, is_plain = np.empty((2, len(words)), np.int64), np.asarray(plain.to_numpy(zero_copy_only=False), bool)
        where[:, is_plain] = 2 * np.arange(len(core)), 1 + marked
        edge, slot = np.array(self.edge, np.int64), np.array([self.slots[w] for w in hard], np.int64)
        where[:, ~is_plain] = 2 * len(core) + edge[slot], edge[slot + 1] - edge[slot]
        pool = np.concatenate([np.stack([core, tail], 1).ravel(), np.array(self.pool, np.int64)])
        begin, n = where[:, np.asarray(coded.indices)]
        return np.repeat(parents, n), pool[np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())]


def _distinct(rows: DataFrame, path: str) -> DataFrame:
    """key, token (null if it is the key), n: the distinct pre-tokens of each task with their frequencies."""
    def gather(batches):
        held = pre_tokens(path)
        total = np.zeros(0, np.int64)

        def flush():
            some = np.flatnonzero(total)
            for i in range(0, len(some), 50_000):
                part = some[i : i + 50_000].tolist()
                yield pa.RecordBatch.from_arrays([pa.array([held.keys[k] for k in part], pa.string()), pa.array([held.texts.get(k) for k in part], pa.string()), pa.array(total[part], pa.int64())], names=["key", "token", "n"])

        for batch in slices(batches, "text", SLICE_BYTES):
            _, number = held.of(batch.column("text"))
            n = np.bincount(number, minlength=len(held.keys))
            n[: len(total)] += total
            total = n
            if held.full():
                yield from flush()
                held.reset()
                total = np.zeros(0, np.int64)
        yield from flush()

    return rows.select("text").mapInArrow(gather, "key string, token string, n long")


def pre_token_pieces(rows: DataFrame, path: str) -> DataFrame:
    """key, n, pieces: every distinct pre-token of the texts with its frequency, its pieces counted once."""
    seen = _distinct(rows, path).groupBy("key", "token").agg(F.sum("n").alias("n"))

    def count(batches):
        pieces = pre_tokens(path).pieces
        for batch in batches:
            keys, tokens = batch.column("key"), batch.column("token").to_pylist()
            found = [pieces(k if t is None else t) for k, t in zip(keys.to_pylist(), tokens)]
            yield pa.RecordBatch.from_arrays([keys, batch.column("n"), pa.array(found, pa.int64())], names=["key", "n", "pieces"])

    return seen.mapInArrow(count, "key string, n long, pieces long")


def _frequent(pieces: DataFrame) -> dict[str, int]:
    """Pieces of the most frequent pre-tokens, in whole classes by the power of two below their frequency, at most BROADCAST."""
    power = F.floor(F.log2("n"))
    least, room = None, BROADCAST
    for r in pieces.groupBy(power.alias("p")).count().orderBy(F.col("p").desc()).collect():  # 63 rows at most
        room -= r["count"]
        if room < 0:
            break
        least = r["p"]
    if least is None:
        return {}
    table = pieces.where(power >= least).select("key", "pieces").toArrow()
    return dict(zip(table.column("key").to_pylist(), table.column("pieces").to_pylist()))


def token_counts(spark: SparkSession, docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of docs (doc_id, text).

    Null and empty texts have 0 bytes and 0 tokens. Repeated and null doc_ids are rows of their own; an empty table gives
    an empty result; other columns are ignored.
    """
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces, _ = materialise_at(spark, pre_token_pieces(rows, vocabulary), "pieces")
    handed = spark.sparkContext.broadcast(_frequent(pieces))

    def measure(batches):
        held, known, get = pre_tokens(vocabulary), np.zeros(0, np.int64), handed.value.get
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = batch.column("text")
            parent, number = held.of(texts)
            new = [get(k, -1) for k in held.keys[len(known) :]]
            known = np.concatenate([known, np.array(new, np.int64)])
            each, rows = known[number], batch.num_rows
            sure = each >= 0
            total = np.bincount(parent[sure], each[sure], minlength=rows).astype(np.int64)
            # the others' frequencies in each document
            code, n = np.unique(parent[~sure] * max(1, len(known)) + number[~sure], return_counts=True)
            of, which = code // max(1, len(known)), (code % max(1, len(known))).tolist()
            edge = np.searchsorted(of, np.arange(rows + 1)).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array([held.keys[k] for k in which], pa.string()), pa.array(n, pa.int64())], names=["key", "n"])
            size = pc.cast(pc.binary_length(pc.fill_null(texts, "")), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, pa.array(total), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pairs)], names=["doc_id", "n_bytes", "known", "rest"])
            if held.full():
                held.reset()
                known = np.zeros(0, np.int64)

    found = rows.mapInArrow(measure, "doc_id long, n_bytes long, known long, rest array<struct<key:string,n:long>>")
    stored, path = materialise_at(spark, found.withColumn("_row", F.monotonically_increasing_id()), "frequencies")
    asked = stored.select("_row", F.explode("rest").alias("r")).select("_row", "r.key", "r.n")
    rest = asked.join(pieces.select("key", "pieces"), "key").groupBy("_row").agg(F.sum(F.col("n") * F.col("pieces")).alias("tokens"))
    out = stored.select("_row", "doc_id", "n_bytes", "known").join(rest, "_row", "left")
    n = F.col("known") + F.coalesce("tokens", F.lit(0))
    return out.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
