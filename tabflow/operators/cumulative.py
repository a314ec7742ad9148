"""Running totals without a single-task window.

``Window.orderBy(x)`` with no partition moves every row to one task. Here
the order column is cut into buckets at approximate quantiles (a one-pass
sketch; only the bucket edges reach the driver, so the plan is fixed and
deterministic on recomputation). Each bucket is one window partition, and a
small per-bucket total table, cumulated over at most ``n_buckets`` rows per
group, supplies the offset each bucket starts from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.session import shuffle_partitions


def quantile_edges(df: DataFrame, col: str, n_buckets: int, rel_err: float | None = None) -> list[float]:
    if n_buckets <= 1:
        return []
    probs = [i / n_buckets for i in range(1, n_buckets)]
    err = rel_err if rel_err is not None else min(0.01, 0.25 / n_buckets)
    edges = df.approxQuantile(col, probs, err)
    return sorted({float(e) for e in edges})


def with_bucket(df: DataFrame, col: str, edges: list[float], out: str = "_bucket") -> DataFrame:
    if not edges:
        return df.withColumn(out, F.lit(0.0))
    splits = [float("-inf")] + edges + [float("inf")]
    tmp = "_bucket_src"
    src = df.withColumn(tmp, F.col(col).cast("double"))
    return Bucketizer(splits=splits, inputCol=tmp, outputCol=out).transform(src).drop(tmp)


def running_sums(
    df: DataFrame,
    order: Sequence[str],
    sums: Sequence[str],
    partition: Sequence[str] = (),
    descending: bool = False,
    n_buckets: int | None = None,
    prefix: str = "cum_",
) -> DataFrame:
    """Add inclusive running sums of ``sums`` ordered by ``order`` (first
    column numeric, non-null; later columns break ties) within ``partition``.
    Rows tied on the whole order get ROWS-frame semantics, like ROW_NUMBER."""
    order, sums, partition = list(order), list(sums), list(partition)
    spark = df.sparkSession
    nb = n_buckets or 2 * shuffle_partitions(spark)
    edges = quantile_edges(df, order[0], nb)
    b = with_bucket(df, order[0], edges)

    sort = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    bsort = F.col("_bucket").desc() if descending else F.col("_bucket").asc()

    totals = b.groupBy(*partition, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    wt = Window.partitionBy(*partition).orderBy(bsort).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *partition, "_bucket",
        *[F.coalesce(F.sum(f"_t_{c}").over(wt), F.lit(0)).alias(f"_o_{c}") for c in sums])
    if not partition:
        # at most n_buckets rows: a proven bound, safe to broadcast
        offsets = F.broadcast(offsets)
    joined = b.join(offsets, on=[*partition, "_bucket"], how="inner")
    w = Window.partitionBy(*partition, "_bucket").orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.sum(c).over(w) + F.col(f"_o_{c}")).alias(f"{prefix}{c}") for c in sums])


def row_numbers(
    df: DataFrame,
    order: Sequence[str],
    partition: Sequence[str] = (),
    out: str = "row_number",
    n_buckets: int | None = None,
) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY partition ORDER BY order) as running
    count, with no task holding a whole partition group."""
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    res = running_sums(one, order, ["_one"], partition, n_buckets=n_buckets, prefix="_rn")
    return res.withColumnRenamed("_rn_one", out).drop("_one")
