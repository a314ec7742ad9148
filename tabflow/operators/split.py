"""Repeatable splits and samples.

Row membership comes from ``md5(seed:key)``, never from ``rand()`` or
``randomSplit``: those depend on partitioning and on task retries, so a
recomputed partition (lost executor) or a validation job that re-creates the
holdout would see different rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.functions.columns import hash_bucket
from tabflow.session import scratch_root

TWO_32 = 1 << 32


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def hash_split(
    df: DataFrame,
    key: str | Sequence[str],
    test_share: float = 0.2,
    seed: int = 0,
    out: str = "split",
    bucket_col: str | None = None,
) -> DataFrame:
    """Mark each row 'test' or 'train': test iff bucket < floor(share * 2^32).

    A narrow projection: no shuffle, identical under any repartitioning.
    """
    b = hash_bucket(seed, *_keys(key))
    threshold = math.floor(test_share * TWO_32)
    res = df.withColumn(out, F.when(b < F.lit(threshold), F.lit("test")).otherwise(F.lit("train")))
    if bucket_col:
        res = res.withColumn(bucket_col, b)
    return res


def train_test(df: DataFrame, key: str | Sequence[str], test_share: float = 0.2, seed: int = 0):
    """(train, test) DataFrames of ``hash_split``; both are filters of one plan."""
    marked = hash_split(df, key, test_share, seed, out="_split")
    return (marked.where(F.col("_split") == "train").drop("_split"),
            marked.where(F.col("_split") == "test").drop("_split"))


#: Labels whose cut points are broadcast; with more, they are joined by a shuffle, to the same result.
BROADCAST_LABELS = 100_000


def _cut(counts: DataFrame, label: str, order: list[str]) -> DataFrame:
    """Per label, the first group (in order) where the running count of ``_n``
    reaches ``_need``, and what is still needed of that group's own rows."""
    w = Window.partitionBy(label).orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order])
    c = counts.withColumn("_cum", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (c.where((F.col("_cum") >= F.col("_need")) & (F.col("_cum") - F.col("_n") < F.col("_need")))
             .select(F.col(f"`{label}`").alias("_l"), *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(order)],
                     (F.col("_need") - (F.col("_cum") - F.col("_n"))).alias("_left")))


def _within(rows: DataFrame, label: str, order: list[str], size: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows (label, order columns, _need) of each label's cut group, with
    ``_need`` lowered to what is needed of them. Groups are counted before the
    shuffle, so a repeated value is one row of the count however often it occurs."""
    counts = rows.groupBy(label, *order, "_need").agg(F.count(F.lit(1)).alias("_n"))
    cut = size(_cut(counts, label, order))
    same = F.col(f"`{label}`").eqNullSafe(F.col("_l"))
    for i, c in enumerate(order):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_c{i}"))
    kept = rows.drop("_need").join(cut, same)
    return kept.drop("_l", *[f"_c{i}" for i in range(len(order))]).withColumnRenamed("_left", "_need")


def _before(pairs: list[tuple[Column, Column]]) -> Column:
    """Whether the first of each pair come before the second ones, nulls first."""
    out = F.lit(False)
    for a, b in reversed(pairs):
        less = F.when(a.isNull(), b.isNotNull()).otherwise(F.coalesce(a < b, F.lit(False)))
        out = less | (a.eqNullSafe(b) & out)
    return out


def stratified_split(
    df: DataFrame,
    label: str,
    key: str | Sequence[str],
    test_share: float = 0.25,
    seed: int = 520692802,
    out: str = "split",
) -> DataFrame:
    """Per label value (null is one), exactly ceil(share * n_label) rows are
    'test': those that come first by (bucket of the key, key, hash of the row).

    No task ranks a label's rows. Counts by a prefix of the bucket find the
    prefix in which the cut lies; only its rows are looked at further: by the
    next prefix, by (bucket, key), and, where a repeated key is cut, by prefixes
    of the row's hash in the same way. What remains at the cut are equal rows,
    of which any will do: they are counted and written out again. Every row is
    then compared with its label's cut in one scan. Keys and labels may be null.
    """
    spark, keys, cols = df.sparkSession, _keys(key), df.columns
    scratch_root(spark)  # checkpoints go to spark.checkpoint.dir
    share = Fraction(str(test_share))
    name = {c: F.col(f"`{c}`") for c in cols}
    d = df.withColumn("_b", hash_bucket(seed, *keys)).withColumn("_h", F.xxhash64(*name.values()))

    first = d.groupBy(label, F.shiftright("_b", 20).alias("_p")).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    total = F.sum("_n").over(Window.partitionBy(label)).cast("decimal(38,0)")
    need = F.ceil(total * F.lit(share.numerator).cast("decimal(12,0)") / F.lit(share.denominator).cast("decimal(12,0)")).cast("bigint")
    few = first.select(label).distinct().count() <= BROADCAST_LABELS

    def size(cuts: DataFrame) -> DataFrame:
        cuts = cuts.checkpoint(eager=True)
        return F.broadcast(cuts) if few else cuts

    cut = size(_cut(first.withColumn("_need", need), label, ["_p"]))
    narrow = d.select(label, *[k for k in keys if k != label], "_b", "_h").withColumn("_p", F.shiftright("_b", 20))
    rows = narrow.join(cut, name[label].eqNullSafe(F.col("_l")) & (F.col("_p") == F.col("_c0")))
    rows = rows.select(label, *[k for k in keys if k != label], "_b", "_h", F.col("_left").alias("_need")).checkpoint(eager=True)
    rows = _within(rows.withColumn("_p", F.shiftright("_b", 8)), label, ["_p"], size)
    rows = _within(rows, label, ["_b", *keys], size)
    for bits in (52, 40):
        rows = _within(rows.withColumn("_p", F.shiftright("_h", bits)), label, ["_p"], size)
    rows = _within(rows, label, ["_h"], size)
    at = rows.groupBy(F.col(f"`{label}`").alias("_l"), F.col("_b").alias("_cb"), F.col("_h").alias("_ch"),
                      *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max("_need").alias("_need"))
    at = size(at)

    marked = d.join(at, name[label].eqNullSafe(F.col("_l")), "left")
    pairs = [(F.col("_b"), F.col("_cb")), *[(name[k], F.col(f"_k{i}")) for i, k in enumerate(keys)], (F.col("_h"), F.col("_ch"))]
    same = F.col("_ch").isNotNull()
    for a, b in pairs:
        same = same & a.eqNullSafe(b)
    test = F.col("_ch").isNotNull() & _before(pairs)
    rest = marked.where(~same).select(*name.values(), F.when(test, "test").otherwise("train").alias(out))
    # the rows at the cut: equal ones are counted, so a group is one row here
    groups = marked.where(same).groupBy(*cols, "_need").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(label).orderBy(*name.values()).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_take", F.greatest(F.lit(0).cast("bigint"), F.least("_n", F.col("_need") - F.coalesce(F.sum("_n").over(w), F.lit(0)))))
    again = groups.select(*name.values(), "_take", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_i"))
    return rest.unionByName(again.select(*name.values(), F.when(F.col("_i") <= F.col("_take"), "test").otherwise("train").alias(out)))


def sample_n(df: DataFrame, n: int, key: str | Sequence[str], seed: int = 0) -> DataFrame:
    """A deterministic sample of min(n, rows) rows: smallest md5 buckets; rows
    of one key go by a hash of the whole row, so the layout plays no part.

    Planned as TakeOrderedAndProject: each task keeps its n best rows."""
    keys = _keys(key)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.orderBy(hash_bucket(seed, *keys), *keys, row).limit(n)


def smoke_rows(df: DataFrame, n: int = 10, key: str | Sequence[str] | None = None) -> DataFrame:
    """First n rows, ordered by key when given so the answer is stable."""
    if key is None:
        return df.limit(n)
    return df.orderBy(*_keys(key)).limit(n)
