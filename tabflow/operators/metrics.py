"""Classifier metrics as aggregates.

Every metric is one aggregation (partial per task, one small row or one row
per slice to the driver if anyone collects it). Area metrics group by score
first, then use bucketed running sums, so no task sees all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import correct_flag
from tabflow.operators.cumulative import running_sums
from tabflow.session import scratch_root

# Fixed value: the per-slice accuracy floor of the demographic check.
SLICE_FLOOR = 0.55


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def accuracy(df: DataFrame, label: str | Column, prediction: str | Column) -> DataFrame:
    """One row: ``n`` rows, ``n_correct``, ``accuracy``."""
    ok = correct_flag(_c(label), _c(prediction))
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(ok).cast("bigint").alias("n_correct"),
                  F.avg(ok).alias("accuracy"))


def confusion_columns(label: Column, prediction: Column, pos=1) -> list[Column]:
    p = F.lit(pos)
    return [
        F.sum(F.when((label == p) & (prediction == p), 1).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when((label != p) & (prediction == p), 1).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when((label != p) & (prediction != p), 1).otherwise(0)).cast("bigint").alias("tn"),
        F.sum(F.when((label == p) & (prediction != p), 1).otherwise(0)).cast("bigint").alias("fn"),
    ]


def binary_metrics(
    df: DataFrame,
    label: str | Column,
    prediction: str | Column,
    probability: str | Column | None = None,
    pos_label=1,
    prefix: str = "",
) -> DataFrame:
    """One row of classifier metrics with positive label ``pos_label``:
    counts, accuracy, precision, recall, f1 and (given a probability of the
    positive class) log loss. Names carry ``prefix`` (e.g. 'test_')."""
    lab, pred = _c(label), _c(prediction)
    aggs = [F.count(F.lit(1)).alias("n"), *confusion_columns(lab, pred, pos_label)]
    if probability is not None:
        p = F.least(F.greatest(_c(probability).cast("double"), F.lit(1e-15)), F.lit(1 - 1e-15))
        y = F.when(lab == F.lit(pos_label), 1.0).otherwise(0.0)
        aggs.append(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))
    c = df.agg(*aggs)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0))
    out = [
        F.col("n").alias(f"{prefix}n"),
        *[F.col(x).alias(f"{prefix}{x}") for x in ("tp", "fp", "tn", "fn")],
        F.when(F.col("n") > 0, (tp + tn) / F.col("n")).alias(f"{prefix}accuracy_score"),
        precision.alias(f"{prefix}precision_score"),
        recall.alias(f"{prefix}recall_score"),
        f1.alias(f"{prefix}f1_score"),
    ]
    if probability is not None:
        out.append(F.col("log_loss").alias(f"{prefix}log_loss"))
    return c.select(*out)


def slice_accuracy(df: DataFrame, slices: Sequence[str] | str, accurate: str = "accurate") -> DataFrame:
    """Per slice: ``acc`` = sum of the 0/1 flag, ``obs`` = rows, ``pct_acc``.
    Rows with a null slice key are dropped (pandas groupby default)."""
    cols = [s.strip() for s in slices.split(",")] if isinstance(slices, str) else list(slices)
    return (df.dropna(subset=cols).groupBy(*cols)
              .agg(F.sum(accurate).cast("bigint").alias("acc"), F.count(F.lit(1)).alias("obs"))
              .withColumn("pct_acc", F.col("acc") / F.col("obs")))


def slice_gate(slices: DataFrame | None, floor: float = SLICE_FLOOR, mode: str = "all") -> DataFrame | str:
    """'pass' / 'fail' per the slice floor; 'none' when there are no slice
    columns. ``mode='all'`` requires every slice above the floor;
    ``mode='any_nonzero'`` is the literal rule of the original notebook
    (passes when any slice has non-zero accuracy)."""
    if slices is None:
        return "none"
    if mode == "all":
        ok = F.min("pct_acc") > F.lit(floor)
    elif mode == "any_nonzero":
        ok = F.max(F.when(F.col("pct_acc") != 0, 1).otherwise(0)) == 1
    else:
        raise ValueError(mode)
    return slices.agg(
        F.when(F.count(F.lit(1)) == 0, F.lit("none")).when(ok, F.lit("pass")).otherwise(F.lit("fail")).alias("demo_test"),
        F.count(F.lit(1)).alias("n_slices"),
        F.min("pct_acc").alias("min_pct_acc"),
    )


def _score_counts(df: DataFrame, label: str | Column, score: str | Column, pos_label=1) -> DataFrame:
    lab = _c(label)
    return (df.select(_c(score).cast("double").alias("score"),
                      F.when(lab == F.lit(pos_label), 1).otherwise(0).cast("bigint").alias("pos"),
                      F.when(lab == F.lit(pos_label), 0).otherwise(1).cast("bigint").alias("neg"))
              .where(F.col("score").isNotNull())
              .groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def roc_pr_auc(df: DataFrame, label: str | Column, score: str | Column, pos_label=1,
               n_buckets: int | None = None) -> DataFrame:
    """One row: ``roc_auc`` (ties count one half) and ``pr_auc`` (trapezoid
    over (recall, precision) points, first point (0, first precision)),
    the same definitions as Spark's BinaryClassificationEvaluator with
    numBins=0."""
    g = _score_counts(df, label, score, pos_label)
    c = running_sums(g, ["score"], ["pos", "neg"], descending=True, n_buckets=n_buckets)
    tp, fp = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(1.0))
    prec0 = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(prec)
    P, N = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    # undefined (null) when one class is absent, instead of a division by zero
    return c.agg(
        F.when(P * N > 0, F.sum(F.col("neg") * (tp - F.col("pos") / 2.0)) / (P * N)).alias("roc_auc"),
        F.when(P > 0, F.sum(F.col("pos") * (prec + prec0) / 2.0) / P).alias("pr_auc"),
    )


def roc_auc(df, label, score, pos_label=1) -> DataFrame:
    return roc_pr_auc(df, label, score, pos_label).select("roc_auc")


def pr_auc(df, label, score, pos_label=1) -> DataFrame:
    return roc_pr_auc(df, label, score, pos_label).select("pr_auc")


def evaluate(df: DataFrame, label: str, prediction: str = "prediction", probability: str = "probability",
             by: str = "split", pos_label=1) -> DataFrame:
    """All classifier metrics of every value of ``by``, one row each, from one
    evaluation of ``df``.

    Rows are counted by (by, probability, prediction) first; that table is
    checkpointed, as everything else is read from it: the confusion counts and
    the log loss are sums over it, and the areas come from prefix sums over
    score ranges, with the totals of the ranges before. Definitions are those
    of ``binary_metrics`` and ``roc_pr_auc``; rows with a null probability
    count for neither log loss nor areas. A null in ``by`` is a value."""
    scratch_root(df.sparkSession)
    pos = F.when(F.col(label) == F.lit(pos_label), 1).otherwise(0)
    counts = (df.select(F.col(by).alias("_by"), F.col(probability).cast("double").alias("_p"), (F.col(prediction) == F.lit(pos_label)).alias("_hit"), pos.cast("bigint").alias("_pos"))
              .groupBy("_by", "_p", "_hit").agg(F.sum("_pos").alias("_pos"), F.sum(1 - F.col("_pos")).alias("_neg")).checkpoint())
    clipped = F.when(F.col("_p").isNotNull(), F.least(F.greatest(F.col("_p"), F.lit(1e-15)), F.lit(1 - 1e-15)))
    both = F.col("_pos") + F.col("_neg")
    hit, miss = F.col("_hit"), ~F.col("_hit")
    some = lambda c, v: F.coalesce(F.sum(F.when(c, v)), F.lit(0)).cast("bigint")
    sums = counts.groupBy("_by").agg(
        F.sum(both).alias("n"), some(hit, F.col("_pos")).alias("tp"), some(hit, F.col("_neg")).alias("fp"),
        some(miss, F.col("_neg")).alias("tn"), some(miss, F.col("_pos")).alias("fn"),
        (-F.sum(F.col("_pos") * F.log(clipped) + F.col("_neg") * F.log(1 - clipped)) / F.sum(F.when(F.col("_p").isNotNull(), both))).alias("log_loss"))
    scores = counts.where("_p is not null").groupBy("_by", "_p").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    c = running_sums(scores.withColumn("_group", F.coalesce(F.col("_by").cast("string"), F.lit(""))).withColumn("_none", F.col("_by").isNull()),
                     ["_p"], ["_pos", "_neg"], partition=["_group", "_none"], descending=True)
    tp, fp = F.col("cum__pos").cast("double"), F.col("cum__neg").cast("double")
    tp0, fp0 = tp - F.col("_pos"), fp - F.col("_neg")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(1.0))
    prec0 = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(prec)
    P, N = F.sum("_pos").cast("double"), F.sum("_neg").cast("double")
    areas = c.groupBy(F.col("_by").alias("_area")).agg(
        F.when(P * N > 0, F.sum(F.col("_neg") * (tp - F.col("_pos") / 2.0)) / (P * N)).alias("roc_auc"),
        F.when(P > 0, F.sum(F.col("_pos") * (prec + prec0) / 2.0) / P).alias("pr_auc"))
    out = sums.join(areas, sums["_by"].eqNullSafe(areas["_area"]), "left")
    a, b, x, y = (F.col(k).cast("double") for k in ("tp", "fp", "tn", "fn"))
    ratio = lambda u, v: F.when(v > 0, u / v).otherwise(F.lit(0.0))
    return out.select(
        F.col("_by").alias(by), "n", "tp", "fp", "tn", "fn", ((a + x) / F.col("n")).alias("accuracy_score"),
        ratio(a, a + b).alias("precision_score"), ratio(a, a + y).alias("recall_score"), ratio(2 * a, 2 * a + b + y).alias("f1_score"),
        "log_loss", "roc_auc", "pr_auc")
