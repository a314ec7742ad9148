import math
from collections import Counter
from fractions import Fraction

from pyspark.sql import functions as F

from tests.conftest import SF001, SF01
from tabflow.operators import split
from tabflow.plans import fixtures as fx


def test_hash_split_share_disjoint_repeatable(spark):
    c = fx.table(spark, SF01, "customer").select("c_custkey")
    a = split.hash_split(c, "c_custkey", 0.2, seed=0)
    b = split.hash_split(c.repartition(7), "c_custkey", 0.2, seed=0)
    ra = dict(a.collect())
    rb = dict(b.collect())
    assert ra == rb
    assert len(ra) == c.count()
    n_test = sum(v == "test" for v in ra.values())
    assert n_test == 291  # equals the DuckDB md5 expression (FIXTURES.md)
    train, test = split.train_test(c, "c_custkey", 0.2, seed=0)
    assert train.join(test, "c_custkey").count() == 0
    assert train.count() + test.count() == c.count()


def test_stratified_split_exact_sizes(spark):
    lab = fx.table(spark, SF01, "labels").select("doc_id", "quality")
    out = split.stratified_split(lab, "quality", "doc_id", 0.25, seed=520692802)
    sizes = {(r.quality, r.split): r["count"] for r in out.groupBy("quality", "split").count().collect()}
    for q, n in lab.groupBy("quality").count().collect():
        assert sizes[(q, "test")] == math.ceil(0.25 * n)
    assert out.count() == lab.count()
    again = split.stratified_split(lab.repartition(5), "quality", "doc_id", 0.25, seed=520692802)
    assert sorted(out.collect()) == sorted(again.collect())


def test_stratified_split_matches_full_ranking_on_big_label(spark):
    # one label holds every row: the hierarchical cut must equal a full rank
    li = fx.table(spark, SF01, "lineitem").select("l_orderkey", "l_linenumber", F.lit(1).alias("g"))
    li = li.dropDuplicates(["l_orderkey", "l_linenumber"])
    out = split.stratified_split(li, "g", ["l_orderkey", "l_linenumber"], 0.3, seed=7)
    from tabflow.functions.columns import hash_bucket
    ranked = (li.withColumn("b", hash_bucket(7, "l_orderkey", "l_linenumber"))
                .orderBy("b", "l_orderkey", "l_linenumber").collect())
    k = math.ceil(0.3 * len(ranked))
    expect = {(r.l_orderkey, r.l_linenumber) for r in ranked[:k]}
    got = {(r.l_orderkey, r.l_linenumber) for r in out.where("split = 'test'").collect()}
    assert got == expect


def test_sample_and_smoke_rows_deterministic(spark):
    c = fx.table(spark, SF001, "customer")
    a = [r.c_custkey for r in split.sample_n(c, 20, "c_custkey").collect()]
    b = [r.c_custkey for r in split.sample_n(c.repartition(3), 20, "c_custkey").collect()]
    assert a == b and len(set(a)) == 20
    s = [r.c_custkey for r in split.smoke_rows(c, 10, "c_custkey").collect()]
    assert s == sorted(r.c_custkey for r in c.select("c_custkey").collect())[:10]


def test_stratified_split_duplicated_key_at_the_cut(spark):
    # 300 copies of one key per label: the cut falls inside the duplicated group
    dup = spark.range(300).select(F.lit(7).alias("k"), (F.col("id") % 2).alias("y"), F.col("id").alias("v"))
    uniq = spark.range(100, 400).select(F.col("id").alias("k"), (F.col("id") % 2).alias("y"), F.col("id").alias("v"))
    df = dup.unionByName(uniq).repartition(4)
    sizes = {r.y: r["count"] for r in df.groupBy("y").count().collect()}
    out = split.stratified_split(df, "y", "k", 0.5, seed=3)
    got = {r.y: r["count"] for r in out.where("split = 'test'").groupBy("y").count().collect()}
    assert got == {y: math.ceil(0.5 * n) for y, n in sizes.items()}
    again = split.stratified_split(df.repartition(3, "v"), "y", "k", 0.5, seed=3)
    assert sorted(out.collect()) == sorted(again.collect())


def test_stratified_split_loses_no_row_with_nulls_and_equal_rows(spark):
    rows = [(k if k % 3 else None, ["a", "b", None][k % 3 if k < 60 else 0], j, None if k % 5 else k)
            for k in range(90) for j in [k % 4, 1]] + [(1, "c", 1, 1)] * 37 + [(None, None, None, None)] * 41
    df = spark.createDataFrame(rows, "k1 int, y string, k2 int, v int").repartition(5)
    counts = Counter(r[1] for r in rows)
    for keys, share in ((["k1", "k2"], 0.25), ("k1", 0.1234567), (["k2"], 0.5)):
        out = split.stratified_split(df, "y", keys, share, seed=11)
        got = out.collect()
        assert Counter(tuple(r)[:4] for r in got) == Counter(rows)
        test = Counter(r.y for r in got if r.split == "test")
        assert test == {y: math.ceil(Fraction(str(share)) * n) for y, n in counts.items()}
        again = split.stratified_split(df.repartition(2), "y", keys, share, seed=11).collect()
        assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_stratified_split_of_nothing(spark):
    df = spark.createDataFrame([], "k int, y int")
    assert split.stratified_split(df, "y", "k").collect() == []


def test_sample_of_a_repeated_key_does_not_depend_on_the_layout(spark):
    df = spark.range(300).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    a, b = (sorted(r.v for r in split.sample_n(x, 5, "k").collect()) for x in (df, df.repartition(7)))
    assert a == b and len(a) == 5


def test_hash_bucket_null_key_parts_differ(spark):
    from tabflow.functions.columns import hash_bucket
    df = spark.createDataFrame([(None, 5), (5, None)], "a int, b int")
    a, b = [r.h for r in df.select(hash_bucket(0, "a", "b").alias("h")).collect()]
    assert a != b
