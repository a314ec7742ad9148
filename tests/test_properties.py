"""Randomised properties (Hypothesis, few examples: each one is a Spark job)."""

import math
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabflow.operators import split
from tabflow.operators.cumulative import running_sums

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50), st.integers(0, 9)),
                         min_size=1, max_size=120)


@SETTINGS
@given(rows=rows_strategy, buckets=st.integers(1, 9))
def test_running_sums_equal_a_window(spark, rows, buckets):
    df = spark.createDataFrame([(g, o, v, i) for i, (g, o, v) in enumerate(rows)], "g int, o int, v int, i int")
    got = running_sums(df, ["o", "i"], ["v"], ["g"], n_buckets=buckets)
    w = Window.partitionBy("g").orderBy("o", "i").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("cum_v", F.sum("v").over(w))
    assert sorted(got.collect()) == sorted(exp.collect())


@SETTINGS
@given(labels=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40)), min_size=1, max_size=150),
       share=st.sampled_from([0.1, 0.25, 0.5, 0.8]))
def test_stratified_sizes_with_duplicate_keys(spark, labels, share):
    df = spark.createDataFrame([(y, k, i) for i, (y, k) in enumerate(labels)], "y int, k int, i int")
    out = split.stratified_split(df, "y", "k", share, seed=11)
    got = {(r.y, r.split): r["count"] for r in out.groupBy("y", "split").count().collect()}
    for y, n in df.groupBy("y").count().collect():
        assert got.get((y, "test"), 0) == math.ceil(Fraction(str(share)) * n)  # exact, not float
    assert out.count() == df.count()
