"""Benchmark decontamination by spaced-seed hashing.

A seed hashes the words of a text at the chosen positions of a fixed mask and ignores the others, so that a hit survives
substituted words. Seeds of documents are joined to those of the benchmark items; around a hit the two texts are laid over
each other on the hit's diagonal and count as overlapping where some window of WINDOW words differs in at most SUBSTITUTIONS
words. Of items of fewer words every word counts:

* items of 8 to 12 words may have one word substituted; as that leaves the first or the last four words as they are, these
  are their seeds;
* items of 4 to 7 words must be in the document as they are, and are their own seed;
* items of 1 to 3 words, which any text may hold by chance, must be the whole document.

Only DataFrame functions are used. A document's words and hashes stay in the row that is being scanned, and nothing but
verified hits is shuffled. The items' seeds are broadcast in blocks of a fixed number of items' words, however many items
there are; each block is a scan.

Edge cases: words are maximal runs of letters, marks and digits in lower case, so punctuation and spacing do not matter;
null or empty texts and items, and those without a word, match nothing; repeated
doc_ids are reported once per item; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import materialise

#: Positions that count; all masks are of one length. Each of them alone hits every window of 13 words of which any 2 are
#: substituted (held by a test).
MASKS = ("11010011", "11001011")
SPAN = len(MASKS[0])
WINDOW, SUBSTITUTIONS = 13, 2
#: Items of fewer words than these: as a whole, without a substitution, and with one.
WHOLE, EXACT, ONE = 4, 8, WINDOW
#: Words of benchmark items whose seeds are broadcast at a time: at most len(MASKS) times as many seeds of some 40 bytes.
BLOCK_WORDS = 200_000
#: Ids of leaked documents that are broadcast; more are joined by a shuffle, to the same result.
BROADCAST_ROWS = 1_000_000


def word_hashes(text: Column) -> Column:
    """64-bit hashes of a text's words, in order."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def seeds(hashes: Column, mask: str, nth: int) -> Column:
    """The seed of a mask at each position of an array of word hashes."""
    at = [k for k, bit in enumerate(mask) if bit == "1"]
    n = F.size(hashes) - len(mask) + 1
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(F.lit(nth), *[hashes[i + k] if k else hashes[i] for k in at]))
    return F.when(n > 0, each).otherwise(F.array().cast("array<bigint>"))


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once: the optimizer may copy a column's expression into a lambda, where it would
    be computed for each element."""
    return F.transform(F.array(value), body)[0]


def _seed_rows(rows: DataFrame, keep: list[str], place: str) -> DataFrame:
    """A row per seed of a frame with ``hashes``: its word position and the seed."""
    every = _let(F.col("hashes"), lambda h: F.concat(*[seeds(h, m, k) for k, m in enumerate(MASKS)]))
    both = rows.select(*keep, F.size("hashes").alias("_n"), every.alias("_s"))
    # the outer form keeps the optimizer from computing the seeds once more for a filter on their number
    each = both.select(*keep, "_n", F.posexplode_outer("_s").alias("_p", "_seed"))
    return each.where(F.col("_seed").isNotNull()).withColumn(place, F.col("_p") % (F.col("_n") - (SPAN - 1))).drop("_n", "_p")


def _best_window(doc: Column, item: Column, i: Column, j: Column, window: Column) -> Column:
    """Of the windows around a hit at word i of the document and word j of the item: (equal words, -first word) of the most
    equal one, null if none fits."""
    reach = WINDOW - 1 + SPAN
    back = F.least(i, j, F.lit(reach))
    span = F.least(F.size(doc) - i, F.size(item) - j, F.lit(reach)) + back
    same = F.zip_with(F.slice(doc, i - back + 1, span), F.slice(item, j - back + 1, span), lambda a, b: (a == b).cast("int"))

    def best(s: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(s) - window), lambda k: F.struct(F.aggregate(F.slice(s, k + 1, window), F.lit(0), lambda a, x: a + x).alias("equal"), (back - i - k).alias("from")))
        return F.when(F.size(s) >= window, F.array_max(each))

    return _let(same, best)


def _blocks(stored: DataFrame) -> list[DataFrame]:
    """Items in blocks of about BLOCK_WORDS words."""
    total = stored.agg(F.sum(F.size("hashes"))).first()[0] or 0
    blocks = -(-total // BLOCK_WORDS)
    return [stored] if blocks == 1 else [stored.where(F.pmod(F.xxhash64("_key"), F.lit(blocks)) == k) for k in range(blocks)]


def _runs(hashes: Column, size: int) -> Column:
    """(word position, seed) of each run of so many words; the seed of a whole document of 1 to 3 words has its length."""
    n = F.size(hashes) - size + 1
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("at"), F.xxhash64(F.lit(-size), *[hashes[i + k] for k in range(size)]).alias("seed")))
    fits = n == 1 if size < WHOLE else n > 0
    return F.when(fits, each).otherwise(F.array().cast("array<struct<at:int,seed:bigint>>"))


def _short(rows: DataFrame, stored: DataFrame) -> list[DataFrame]:
    """Verified hits of items of fewer words than a window: doc_id, item_id, window and b (equal words, -first word). The
    documents are scanned for the lengths that items have."""
    lengths = sorted({r["n"] if r["n"] < EXACT else 4 for r in stored.select(F.size("hashes").alias("n")).distinct().collect()})  # 7 at most
    if not lengths:
        return []
    every = _let(F.col("hashes"), lambda h: F.concat(*[_runs(h, n) for n in lengths]))
    seeded = rows.select("doc_id", "hashes", F.explode(every).alias("r")).select("doc_id", "hashes", F.col("r.at").alias("_i"), F.col("r.seed").alias("_seed"))
    n, out = F.size("hashes"), []
    seed = lambda size, at: F.xxhash64(F.lit(-size), *[F.get("hashes", at + k) for k in range(size)])
    own = F.when(n >= EXACT, F.array(F.struct(F.lit(0).alias("j"), seed(4, F.lit(0)).alias("s")), F.struct((n - 4).alias("j"), seed(4, n - 4).alias("s"))))
    for size in range(1, EXACT):
        own = own.when(n == size, F.array(F.struct(F.lit(0).alias("j"), seed(size, F.lit(0)).alias("s"))))
    for block in _blocks(stored):
        theirs = block.select("item_id", F.col("hashes").alias("_item"), F.explode(own).alias("o")).select("item_id", "_item", F.col("o.j").alias("_j"), F.col("o.s").alias("_seed"))
        hits = seeded.join(F.broadcast(theirs), "_seed").withColumn("_from", F.col("_i") - F.col("_j"))
        size = F.size("_item")
        hits = hits.where((F.col("_from") >= 0) & (F.col("_from") + size <= F.size("hashes")))
        equal = F.aggregate(F.zip_with(F.slice("hashes", F.col("_from") + 1, size), F.col("_item"), lambda a, b: (a == b).cast("int")), F.lit(0), lambda t, x: t + x)
        hits = hits.select("doc_id", "item_id", size.alias("window"), F.struct(equal.alias("equal"), (-F.col("_from")).alias("from")).alias("b"))
        out.append(hits.where(F.col("b.equal") >= F.col("window") - F.when(F.col("window") >= EXACT, 1).otherwise(0)))
    return out


def overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Overlaps of docs (doc_id, text) with benchmark items (item_id, text): a row per document and item with the number of
    verified hits, where in the document the best window begins (in words), its length and its equal words."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_hashes(F.col("text")).alias("hashes"))
    stored = materialise(spark, items.where(F.size("hashes") > 0).withColumn("_key", F.monotonically_increasing_id()), "items")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_hashes(F.col("text")).alias("hashes"))
    seeded, scans = _seed_rows(rows, ["doc_id", "hashes"], "_i"), []
    for own in _blocks(stored.where(F.size("hashes") >= ONE)):
        theirs = _seed_rows(own, ["_key"], "_j")
        hits = seeded.join(F.broadcast(theirs), "_seed")
        hits = hits.join(F.broadcast(own.select("_key", "item_id", F.col("hashes").alias("_item"))), "_key")
        best = _best_window(F.col("hashes"), F.col("_item"), F.col("_i"), F.col("_j"), F.lit(WINDOW))
        hits = hits.select("doc_id", "item_id", F.lit(WINDOW).alias("window"), best.alias("b"))
        scans.append(hits.where(F.col("b.equal") >= WINDOW - SUBSTITUTIONS))
    scans += _short(rows, stored.where(F.size("hashes") < ONE))
    if not scans:
        return spark.createDataFrame([], "doc_id long, item_id long, n_hits long, word_from int, n_words int, n_equal int")
    found = reduce(DataFrame.unionByName, scans)
    return found.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_hits"), F.max(F.struct("b.equal", "b.from", "window")).alias("m")).select(
        "doc_id", "item_id", "n_hits", (-F.col("m.from")).cast("int").alias("word_from"), F.col("m.window").alias("n_words"), F.col("m.equal").alias("n_equal"))


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that overlap with an item."""
    hit = materialise(spark, overlaps(spark, docs, benchmark).select(F.col("doc_id").alias("_leaked")).distinct(), "leaked")
    if hit.count() <= BROADCAST_ROWS:
        hit = F.broadcast(hit)
    return docs.join(hit, F.col("doc_id").cast("long").eqNullSafe(F.col("_leaked")), "left_anti")
