"""Connected components of a large edge table, by DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import drop_table, materialise_at


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of the edges (a, b), two longs; loops and repeats do no harm.

    Alternates large-star (each node hands its larger neighbours to its smallest) and small-star (each node hands its
    smaller neighbours, and itself, to the smallest) until the edges are stars. A node's edges are summed before they are
    shuffled, so that a hub is no more than one row for each task; the join that hands the minimum back is split by adaptive
    execution where a hub is hot. Each round is written, the one before deleted.
    """
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # stars no longer change: their number and the sum of their hashes stay
    sign = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    current, path = materialise_at(spark, edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).distinct(), "edges")
    before = None
    while True:
        # large star: u's neighbours above u are joined to the least of u and its neighbours
        n = both(current).where(F.col("a") != F.col("b"))
        least = n.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = n.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        loops = current.where(F.col("a") == F.col("b"))
        large, large_path = materialise_at(spark, large.unionByName(loops), "edges")
        # small star: u's neighbours below u, and u, are joined to the least of them
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        small = small.where(F.col("a") != F.col("b")).unionByName(loops).distinct()
        after, after_path = materialise_at(spark, small, "edges")
        drop_table(spark, path)
        drop_table(spark, large_path)
        current, path, last, before = after, after_path, before, sign(after)
        if before == last:
            break
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
