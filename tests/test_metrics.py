import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tests.conftest import SF01
from tabflow.operators import metrics
from tabflow.operators.cumulative import row_numbers, running_sums
from tabflow.plans import fixtures as fx


def test_areas_equal_mllib_evaluator(spark):
    s = fx.scored_rows(spark, SF01)
    got = metrics.roc_pr_auc(s, "label", "score", n_buckets=5).first()
    ev = s.select(F.col("score").alias("rawPrediction"), F.col("label").cast("double").alias("label"))
    roc = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(ev)
    pr = BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0).evaluate(ev)
    assert got.roc_auc == pytest.approx(roc, abs=1e-12)
    assert got.pr_auc == pytest.approx(pr, abs=1e-12)


def test_areas_with_ties(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (1, 0.1), (0, 0.1)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = metrics.roc_pr_auc(df, "label", "score", n_buckets=3).first()
    ev = df.select(F.col("score").alias("rawPrediction"), F.col("label").cast("double").alias("label"))
    assert got.roc_auc == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(ev))
    assert got.pr_auc == pytest.approx(
        BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0).evaluate(ev))


def test_running_sums_match_window(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("g"), ((F.col("id") * 7919) % 5003).alias("o"),
                                      (F.col("id") % 3).alias("v"))
    got = running_sums(df, ["o"], ["v"], ["g"], n_buckets=9)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("cum_v", F.sum("v").over(w))
    assert sorted(got.collect()) == sorted(exp.collect())
    rn = row_numbers(df, ["o"], ["g"], n_buckets=4)
    exp_rn = df.withColumn("row_number", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert sorted(rn.collect()) == sorted(exp_rn.collect())


def test_binary_metrics_and_slices(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", 0.9), (1, 0, "a", 0.4), (0, 0, "b", 0.2), (0, 1, "b", 0.7), (1, 1, None, 0.8)],
        "label int, prediction int, s string, p double")
    m = metrics.binary_metrics(df, "label", "prediction", "p", prefix="test_").first()
    assert (m.test_tp, m.test_fp, m.test_tn, m.test_fn) == (2, 1, 1, 1)
    assert m.test_precision_score == pytest.approx(2 / 3)
    assert m.test_recall_score == pytest.approx(2 / 3)
    assert m.test_accuracy_score == pytest.approx(3 / 5)
    flagged = df.withColumn("accurate", (F.col("label") == F.col("prediction")).cast("int"))
    sl = metrics.slice_accuracy(flagged, "s")
    assert {r.s: (r.acc, r.obs) for r in sl.collect()} == {"a": (1, 2), "b": (1, 2)}  # null slice dropped
    assert metrics.slice_gate(sl).first().demo_test == "fail"        # 0.5 is not above 0.55
    assert metrics.slice_gate(sl, mode="any_nonzero").first().demo_test == "pass"
    assert metrics.slice_gate(None) == "none"


def test_constant_label(spark):
    from tabflow.operators import model
    df = spark.createDataFrame([(1, 1, 0.2), (1, 0, 0.9), (1, 1, 0.4)], "label int, prediction int, score double")
    a = metrics.roc_pr_auc(df, "label", "score", n_buckets=2).first()
    assert a.roc_auc is None and a.pr_auc == pytest.approx(1.0)
    none = metrics.roc_pr_auc(df.withColumn("label", F.lit(0)), "label", "score", n_buckets=2).first()
    assert none.roc_auc is None and none.pr_auc is None
    m = metrics.binary_metrics(df.withColumn("label", F.lit(0)), "label", "prediction").first()
    assert m.recall_score == 0.0 and m.tp == 0
    rows = spark.range(200).select((F.col("id") % 7).cast("double").alias("x"), F.lit(0).alias("label"))
    params = dict(model.PRODUCTION_PARAMS, n_estimators=2, min_child_samples=5)
    fit = model.train_production(rows, ["x"], "label", params)
    assert {r.prediction for r in model.score(fit, rows).select("prediction").distinct().collect()} == {0}
