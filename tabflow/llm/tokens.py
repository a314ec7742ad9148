"""Encoding of whole texts with a vocabulary file of the ``tokenizers`` library, through a cache of pieces.

A byte-level tokenizer of this kind encodes each pre-token by itself, and where pre-tokens end can often be seen from the
two characters around: before a blank between two non-blank characters (the blank starts the next pre-token), between a
letter and a comma. Texts are cut there into pieces of one or a few pre-tokens ("end", "end," and "end." share one), and
each distinct piece needs encoding only once while a worker's cache holds it. Texts with other runs of white space next to
a blank, and vocabularies of another kind, are handed to the library whole; all ways give the ids of
``encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import json
import os
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces a worker keeps; when it has more, the cache starts anew. It changes no result.
CACHE_WORDS = 800_000
#: Pieces that start with a blank encoded in one call.
JOIN_WORDS = 4000
#: Other pieces encoded in one call.
CUT_WORDS = 40_000

_SPACE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1c}-\x{1f}]"
_RISKY = f" {_SPACE}|{_SPACE} |^{_SPACE}|{_SPACE}$"

#: Letters of which every Unicode version of the last decades says so: Latin, Greek, Cyrillic, kana, Han, Hangul.
LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02c1\u0388-\u038a\u038e-\u03a1\u03a3-\u03e1\u0400-\u0481\u048a-\u0513\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_OTHER = f"[^\t-\r -~{LETTERS}]"


def _cut_table(plain: bool) -> np.ndarray:
    """Whether a pre-token surely begins at a byte (1) or does if one begins at the next (2), by the byte before (times 256)
    and the byte itself, for texts without blanks next to white space. In plain texts every character beyond ASCII is one
    of LETTERS."""
    kind = ["?"] * 256  # unknown
    for b in range(33, 127):
        kind[b] = "a" if chr(b).isalpha() else "0" if chr(b).isdigit() else "'" if chr(b) == "'" else "."
    kind[9:14], kind[32] = "s" * 5, " "
    if plain:
        kind[128:] = "a" * 128

    def begins(x: str, y: str) -> int:
        if y == " ":
            return 1
        if "?" in (x, y) or x == " ":
            return 0
        if x == "s":  # the last of several white spaces before something else is a pre-token of its own
            return (2 if y == "s" else 1) if plain else 0
        return int(x != y and (x, y) not in ((".", "'"), ("'", "."), ("'", "a")))  # the last: "'s" is a pre-token

    return np.array([begins(x, y) for x in kind for y in kind], np.uint8)


_CUTS = {plain: _cut_table(plain) for plain in (True, False)}

_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a vocabulary file; kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True  # in a text these strings are ordinary text
        self.size = self.lib.get_vocab_size()
        self.starts = np.array([(self.lib.id_to_token(i) or "").startswith("Ġ") for i in range(self.size)])
        spec = json.loads(self.lib.to_str())
        before = spec.get("pre_tokenizer") or {}
        kind = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        # added tokens that are not special may span pre-tokens
        self.by_piece = spec.get("normalizer") is None and kind and all(t["special"] for t in spec.get("added_tokens") or [])
        self._reset()

    def _reset(self) -> None:
        self.slots: dict[str, int] = {}
        self.pool, self.edge, self.n = np.empty(1 << 20, np.uint32), np.zeros(1 << 16, np.int64), 0

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _keep(self, pieces: list[str], ids: np.ndarray, cuts: np.ndarray) -> None:
        """Cache the ids of some pieces, of which piece i has those from cuts[i] to cuts[i + 1]."""
        used, n = int(self.edge[self.n]), self.n
        while used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        while n + len(pieces) >= len(self.edge):
            self.edge = np.concatenate([self.edge, np.empty_like(self.edge)])
        self.pool[used : used + len(ids)] = ids
        self.edge[n : n + len(pieces) + 1] = used + cuts
        self.slots.update(zip(pieces, range(n, n + len(pieces))))
        self.n += len(pieces)

    def _kept(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids in some slots, one after the other, and where each slot's end."""
        begin = self.edge[slot]
        length = self.edge[slot + 1] - begin
        end = np.cumsum(length)
        return self.pool[np.repeat(begin - end + length, length) + np.arange(end[-1] if len(end) else 0)], end

    def _learn(self, pieces: list[str]) -> None:
        """Cache what the library gives for pieces that are not cached. Many that start with a blank are encoded in one
        call: a token that starts with the blank begins one."""
        first = [x for x in pieces if x[0] == " "]
        for i in range(0, len(first), JOIN_WORDS):
            part = first[i : i + JOIN_WORDS]
            ids = self._whole(["".join(part)])[0]
            cuts = np.append(np.flatnonzero(self.starts[ids]), len(ids))
            if len(cuts) != len(part) + 1:  # a token of this vocabulary spans words
                got = self._whole(part)
                ids, cuts = np.concatenate(got), np.cumsum([0, *map(len, got)])
            self._keep(part, ids, cuts)
        later = [x for x in pieces if x[0] != " "]
        for i in range(0, len(later), CUT_WORDS):
            got = self._whole(part := later[i : i + CUT_WORDS])
            self._keep(part, np.concatenate(got), np.cumsum([0, *map(len, got)]))

    def _by_piece(self, texts: pa.Array, plain: bool) -> list[np.ndarray]:
        """The ids of texts without nulls and without blanks next to white space."""
        texts = texts.cast(pa.large_string())
        _, offsets, chars = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(chars or b"", np.uint8)[at[0] : at[-1]]
        at = at - at[0]
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            begins = _CUTS[plain].take(data[:-1].astype(np.uint16) << 8 | data[1:])
            cut[1:-1] = begins == 1
            cut[at] = False
            runs = np.flatnonzero(begins == 2) + 1
            cut[runs] = cut[runs + 1]
        cut[at] = True
        edge = np.flatnonzero(cut)
        n = len(edge) - 1
        if n < 1:
            return [np.empty(0, np.uint32)] * len(texts)
        coded = pc.dictionary_encode(pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(edge), pa.py_buffer(data)]))
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        slot = np.fromiter(map(self.slots.get, distinct, repeat(-1)), np.int64, len(distinct))
        if len(new := np.flatnonzero(slot < 0)):
            pieces = [distinct[i] for i in new.tolist()]
            self._learn(pieces)
            slot[new] = list(map(self.slots.__getitem__, pieces))
        ids, end = self._kept(slot[np.asarray(coded.indices)])
        cuts = np.append(0, end)[np.searchsorted(edge, at)]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids (uint32) of every text; null counts as empty."""
        if self.n > CACHE_WORDS:
            self._reset()
        texts = pc.fill_null(texts, "")
        if not self.by_piece:
            return self._whole(texts.to_pylist())
        risky, other = (np.asarray(pc.match_substring_regex(texts, x).to_numpy(zero_copy_only=False), bool) for x in (_RISKY, _OTHER))
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        for i in np.flatnonzero(risky):
            out[i] = self._whole([texts[int(i)].as_py()])[0]
        for plain in (True, False):
            some = np.flatnonzero(~risky & (other != plain))
            if len(some):
                for i, ids in zip(some, self._by_piece(texts.take(pa.array(some)), plain)):
                    out[i] = ids
        return out
