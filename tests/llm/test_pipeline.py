"""The queries and the pipeline, on the small tables and on a fixture held against brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tabflow.llm import common, queries
from tests.conftest import SF001


def test_every_query_is_registered():
    import __spark_entry__

    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "pii", "best_fit_packing"]


@pytest.mark.parametrize("name", ["op3_pii", "op6_language_id"])
def test_queries_give_a_row_per_document(spark, name):
    n = spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert queries.QUERIES[name](spark, SF001).count() == n


def test_pipeline_on_a_fixture(spark, tmp_path):
    rng = random.Random(11)
    english, german = "the of and that with from this have some more".split(), "der die und nicht eine auch sich werden nach aus".split()
    say = lambda words, n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
    rows = [(i, say(english if i % 2 else german, 40), "en" if i % 2 else "de") for i in range(100, 160)]
    leak = say(english, 30)
    rows += [(200, rows[0][1], "de"), (201, rows[0][1] + " und", "de"), (90, rows[3][1], "en"), (90, rows[3][1], "en")]
    rows += [(210, say(english, 20) + " " + leak + " " + say(english, 20), "en"), (220, say(german, 30) + " write me@ex.org " + say(german, 30), "de")]
    rows += [(230, "zzzz qqqq xxxx vvvv kkkk " * 20, None), (231, "12345 678", None), (232, None, "en"), (240, say(english, 3000), "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak.upper())], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    gone = {200, 201, 103, 210, 230, 231, 232}
    kept = {i: t for i, t, _ in rows if i not in gone}
    kept[220] = kept[220].replace("me@ex.org", "[email]")
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.doc_id for r in got} == set(kept)
    sequences = {}
    for i, text in kept.items():
        ids = np.array([*lib.encode(text, add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted((r.start, r.length, r.ids_crc32) for r in got if r.doc_id == i)
        assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1].tolist()]
        assert all(zlib.crc32(ids[a : a + n]) == c for a, n, c in pieces) and sum(p[1] for p in pieces) == len(ids)
    for r in got:
        sequences[r.sequence_id] = sequences.get(r.sequence_id, 0) + r.length
    assert max(sequences.values()) <= 2048 and len(sequences) <= -(-sum(sequences.values()) // 2048) + 1


def test_rows_are_told_apart_by_their_texts(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(30)) for x in "pq")
    rows = [(1, a), (1, b), (2, b), (None, a), (None, a), (3, None), (3, None), (4, ""), (5, b + " end"), (None, "alone")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == list(corpus_pipeline.COLUMNS)
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (3, None), (3, None), (4, ""), (None, "alone")], key=str)
    assert corpus_pipeline.near_duplicates(spark, docs.where("false"), "").collect() == []


def test_a_task_gives_back_the_memory_it_has_freed():
    import ctypes
    import os

    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("not the GNU C library")

    def resident() -> float:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6

    last = []

    def work(batches):
        held = [bytearray(b"x" * 60_000) for _ in range(6000)]
        last.append(bytearray(b"x" * 60_000))  # what is kept behind them holds the freed ones in the process
        yield from batches
        del held

    plain, before = list(work(iter([1]))), resident()
    assert plain == [1]
    kept = list(common.frugal(work)(iter([1, 2])))
    assert kept == [1, 2] and resident() < before - 200


def test_python_tasks_of_the_stages_before_native_ones_give_back_memory(spark, monkeypatch, tmp_path):
    calls = tmp_path / "calls"
    monkeypatch.setattr(common, "give_back", lambda: open(calls, "a").write("x"))
    docs = spark.createDataFrame([(i, f"some words of text number {i} that are long enough to be told apart", "en", "web", 60) for i in range(6)], "doc_id long, text string, lang string, source string, n_chars long")
    from tabflow.llm import jaccard, langid

    jaccard.similar_documents(spark, docs).count()
    after = calls.stat().st_size if calls.exists() else 0
    langid.identify(spark, docs).count()
    assert 0 < after < calls.stat().st_size
