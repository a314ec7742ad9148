"""Encoding, record files and packing."""

import io
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tabflow.llm import pack, records, tokens
from tabflow.llm.tokens import Encoder

from .conftest import ODD_TEXTS, frame

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(plain):
    texts = [t for _, t in ODD_TEXTS] + ["it's  don't", "a\xa0b c", " x", "x ", "\x1c a", "a  b", "a.\nB, c.\nd", "²3 ½ a1b2"]
    rng = random.Random(1)
    texts += ["".join(rng.choice(" \n\tab.,'é1") for _ in range(60)) for _ in range(200)]
    enc = Encoder(VOCABULARY)
    for _ in range(2):  # the second time from the cache
        for text, ids in zip(texts, enc.encode(pa.array(texts, pa.string()))):
            assert ids.tolist() == plain(text), text


def test_words_are_put_together_from_pre_tokens(plain, monkeypatch):
    enc, asked = Encoder(VOCABULARY), []
    whole = Encoder._whole
    monkeypatch.setattr(Encoder, "_whole", lambda self, texts: asked.extend(texts) or whole(self, texts))
    texts = ["x sturmwind sturmwind, sturmwind.\nUnd sturmwind's", "x sturmwind; (sturmwind) sturmwind,und"]
    for text in texts:
        assert enc.encode(pa.array([text]))[0].tolist() == plain(text)
    assert sum(t.count("sturmwind") for t in asked) == 2  # behind a blank and, after the bracket, without


def test_texts_are_cut_before_words_are_looked_up(plain):
    enc = Encoder(VOCABULARY)
    texts = ["sturmwind sturmwind, sturmwind; sturmwind.\n\nUnd sturmwind's sturmwind99", None, "sturmwind.", "sturmwind, \u2026 sturmwind; sturmwind.\nUnd"]
    for text, ids in zip(texts, enc.encode(pa.array(["", *texts]).slice(1)), strict=True):
        assert ids.tolist() == plain(text), text
    assert set(enc.slots) == {"sturmwind", " sturmwind", ",", ";", ".", "\n", "Und", "'s", "99", " \u2026", "\nUnd"}


def test_cuts_change_no_ids(plain):
    rng, enc = random.Random(3), Encoder(VOCABULARY)
    some = ["ab'stdmrevl.,-1 2\n\t", "a\n\r\x0b\x0c.' ", "\u00e9'\u00dfs.,\n 1\u0436\u65e5\ud55c\u00aa", "a \xa0 \n.'\u2026\x1c\x7f\u00d7\u00b2\u200b\x85"]
    for _ in range(60):
        texts = ["".join(rng.choice(rng.choice(some[: rng.choice((1, 2, 4))])) for _ in range(rng.randrange(30))) for _ in range(30)]
        for text, ids in zip(texts, enc.encode(pa.array(texts, pa.string())), strict=True):
            assert ids.tolist() == plain(text), text


def test_pre_tokens_are_those_of_the_library(plain):
    letters = "".join(map(chr, range(0x110000 - 1))).encode("utf-8", "ignore").decode()
    letters = "".join(re.findall(f"[{tokens.LETTERS}]", letters))
    assert len(Tokenizer.from_file(VOCABULARY).pre_tokenizer.pre_tokenize_str(letters)) == 1
    rng = random.Random(2)
    some = "aZ09'\"`_~!-/:<|>\t\n\r\x0b\x0cstmdrevl" + "\u00aa\u00b5\u00df\u00e9\u02c1\u03a9\u0436\u3042\u30ab\u65e5\ud55c" + "\u00b2\u00d7\u0301\u0660\x1c\x7f\x85\u200b\U0001f600"
    texts = [" ".join("".join(rng.choice(some[: rng.choice((20, 36, 47, 99))]) for _ in range(rng.choice((1, 2, 5, 9)))) for _ in range(30)) for _ in range(400)]
    texts += ["it's 's 'll'd don't'tt a''s 'S ''", "a\n\n\nb c\n\t\rd e\n\n\n\n", "<|endoftext|> x<|endoftext|>y z"]
    enc = Encoder(VOCABULARY)
    for _ in range(2):  # the second time from the cache
        for text, ids in zip(texts, enc.encode(pa.array(texts, pa.string()))):
            assert ids.tolist() == plain(text), text


def test_an_added_token_may_span_pre_tokens(tmp_path):
    lib = Tokenizer.from_file(VOCABULARY)
    lib.add_tokens(["end.Of"])
    lib.save(path := str(tmp_path / "added.json"))
    assert Encoder(path).encode(pa.array(["a end.Of, b"]))[0].tolist() == lib.encode("a end.Of, b", add_special_tokens=False).ids


def test_a_full_cache_changes_nothing(plain, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    monkeypatch.setattr(tokens, "CUT_WORDS", 2)
    enc = Encoder(VOCABULARY)
    for text in ["a b, c. d", "b, b c; \u4e00\u03a9! \U0001f600x", "", "d a b,"] * 3:
        assert enc.encode(pa.array([text]))[0].tolist() == plain(text)


def test_encoder_of_another_kind_of_vocabulary():
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    lib.encode_special_tokens = True
    texts = ["Hello  World", "a b", ""]
    assert [x.tolist() for x in Encoder(path).encode(pa.array(texts))] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def _crc(data):
    c = 0xFFFFFFFF
    for x in data:
        c ^= x
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
    c ^= 0xFFFFFFFF
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def test_masked_checksums():
    rng = np.random.default_rng(0)
    data = [b"123456789", *(rng.bytes(int(n)) for n in (4, 255, 256, 257, 1000, 5000))]
    assert records.masked_crc32c(data).tolist() == [_crc(d) for d in data]
    assert [records._masked_small(d) for d in data] == [_crc(d) for d in data]


def test_damaged_frames_are_noticed():
    good = b"".join(records.frame([b"abcdefgh" * 9, b"12345678"]))
    assert [d for g in records.read_frames(io.BytesIO(good)) for d in g] == [b"abcdefgh" * 9, b"12345678"]
    for at in (0, 9, 20, len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(records.read_frames(io.BytesIO(bytes(bad))))
    with pytest.raises(ValueError):
        list(records.read_frames(io.BytesIO(good[:-3])))


def test_records_round_trip(spark, odd, plain):
    folder = records.scratch_path(spark, "test-records")
    index = records.write_records(spark, odd, VOCABULARY, 0, folder)
    back = records.with_starts(spark, records.read_records(spark, index, folder), index).orderBy("start").collect()
    order = sorted(ODD_TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    start = 0
    for row, (key, text) in zip(back, order, strict=True):
        ids = np.array([*plain(text), 0], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (key, start, len(ids), zlib.crc32(ids))
        start += len(ids)
    rows = index.where("doc_id in (6, 8)").collect()
    texts = dict(ODD_TEXTS)
    for key, ids in records.read_at(rows, folder):
        assert ids.tolist() == [*plain(texts[key]), 0]


def test_one_id_fills_several_files(spark):
    rows = [(None if k % 3 else 7, f"{k * 7919 % 1000:03d} words") for k in range(600)]
    docs = frame(spark, rows)
    index = records.write_records(spark, docs, VOCABULARY)
    assert index.where("doc_id is null").select("file").distinct().count() > 1
    got = records.with_starts(spark, records.read_records(spark, index), index).orderBy("start").collect()
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    crc = lambda t: zlib.crc32(np.array([*Tokenizer.from_file(VOCABULARY).encode(t, add_special_tokens=False).ids, 0], "<u4"))
    assert [(r.doc_id, r.ids_crc32) for r in got] == [(k, crc(t)) for k, t in order]


def test_records_of_nothing(spark, empty):
    assert records.token_records(spark, empty, VOCABULARY).collect() == []


def _check_packing(rows, expected, capacity):
    """Pieces cover their documents, sequences are gapless and within the capacity; returns the number of sequences."""
    docs, seqs = {}, {}
    for r in rows:
        docs.setdefault((r.doc_id, r.start + 0), []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(len(x) for x in expected)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_pack(spark, odd, plain):
    rows = pack.pack(spark, odd, VOCABULARY, 64).collect()
    expected = [[*plain(t), 0] for _, t in ODD_TEXTS]
    n = _check_packing(rows, expected, 64)
    total = sum(map(len, expected))
    assert n <= -(-total // 64) + 2
    for key, text in ODD_TEXTS:
        if key == 7:
            continue  # repeated
        ids = np.array([*plain(text), 0], "<u4")
        parts = sorted((r.start, r.piece, bytes(r.ids), r.length, r.ids_crc32) for r in rows if r.doc_id == key)
        assert b"".join(p[2] for p in parts) == ids.tobytes()
        assert [p[1] for p in parts] == list(range(len(parts)))
        assert all(p[3] == 64 for p in parts[1:]) and all(zlib.crc32(p[2]) == p[4] for p in parts)
    assert sum(r.doc_id == 7 for r in rows) == 2
    whole = pack.sequences(pack.pack(spark, odd, VOCABULARY, 64)).collect()
    assert len(whole) == n and all(len(r.ids) == 4 * r.n_tokens for r in whole)


def test_pack_nothing(spark, empty):
    assert pack.pack(spark, empty, VOCABULARY).collect() == []


@pytest.mark.parametrize("seed", range(12))
def test_plans_hold_every_piece_and_are_near_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 100, 2048])
    histogram = {}
    for _ in range(rng.choice([1, 5, 50, 2000])):
        n = min(capacity, 1 + int(rng.expovariate(1 / (capacity * rng.choice([0.1, 0.4])))))
        histogram[n] = histogram.get(n, 0) + rng.choice([1, 1, 3, 40])
    runs, sequences = pack.plan_runs(histogram, capacity)
    room, seen = {}, dict.fromkeys(histogram, 0)
    for i, r in runs.iterrows():
        after = runs[(runs.length == r.length) & (runs.rank_from > r.rank_from)].rank_from.min()
        count = int((after if after == after else histogram[r.length]) - r.rank_from)
        for k in range(count):
            s = r.seq_from + k // r.times
            room.setdefault(s, []).append((r.offset + k % r.times * r.length, r.length))
            seen[r.length] += 1
    assert seen == histogram and len(room) == sequences
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    # first-fit decreasing by hand
    bins = []
    for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        fits = [i for i, b in enumerate(bins) if b + n <= capacity]
        if fits:
            bins[max(fits, key=lambda i: bins[i])] += n
        else:
            bins.append(n)
    assert sequences <= len(bins)
