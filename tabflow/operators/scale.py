"""Mean imputation and standardisation.

Both are estimator/transformer pairs: ``fit`` is one global aggregate
(partial per task, one row to the driver), ``transform`` is a projection
with the fitted numbers as literals — no join, no broadcast, no window.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _missing(c: str):
    col = F.col(f"`{c}`")
    return col.isNull() | F.isnan(col)


def fit_means(df: DataFrame, cols: Iterable[str]) -> dict[str, float | None]:
    cols = list(cols)
    row = df.select(*[
        F.avg(F.when(~_missing(c), F.col(f"`{c}`").cast("double"))).alias(c) for c in cols
    ]).first()
    return {c: row[c] for c in cols}


def impute_mean(df: DataFrame, cols: Iterable[str], means: Mapping[str, float | None] | None = None) -> DataFrame:
    """Replace null and NaN with the column mean (of non-missing values)."""
    cols = list(cols)
    means = dict(means) if means is not None else fit_means(df, cols)
    out = []
    for c in df.columns:
        if c in cols:
            out.append(F.when(_missing(c), F.lit(means[c]).cast("double"))
                       .otherwise(F.col(f"`{c}`").cast("double")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def fit_scaling(df: DataFrame, cols: Iterable[str]) -> dict[str, tuple[float | None, float | None]]:
    cols = list(cols)
    aggs = []
    for c in cols:
        aggs += [F.avg(f"`{c}`").alias(f"m_{c}"), F.stddev_pop(f"`{c}`").alias(f"s_{c}")]
    row = df.select(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def standardize(df: DataFrame, cols: Iterable[str], stats: Mapping[str, tuple] | None = None) -> DataFrame:
    """Centre and scale to unit (population) variance; zero deviation -> 0."""
    cols = list(cols)
    stats = dict(stats) if stats is not None else fit_scaling(df, cols)
    out = []
    for c in df.columns:
        if c in cols:
            mean, sd = stats[c]
            x = F.col(f"`{c}`").cast("double")
            if sd is None or sd == 0 or (isinstance(sd, float) and math.isnan(sd)):
                out.append(F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0)).alias(c))
            else:
                out.append(((x - F.lit(mean)) / F.lit(sd)).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


# ---------------------------------------------------------------- mergeable state

def moment_state(df: DataFrame, cols: Iterable[str], by: str) -> DataFrame:
    """(``by``, column, n, mean, m2) of the non-missing values: what a month's
    rows add to the fits of ``impute_mean`` and ``standardize``. Stored, it
    spares later fits a scan of that month."""
    values = df.select(F.col(f"`{by}`").alias(by), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.when(~_missing(c), F.col(f"`{c}`").cast("double")).alias("x")) for c in cols])).alias("p"))
    x = F.col("p.x")
    return values.groupBy(by, F.col("p.column").alias("column")).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"))


def merge_moments(state: DataFrame) -> dict[str, tuple[float | None, float | None]]:
    """column: (mean, population deviation) over all rows of the states (a row
    per column reaches the driver); for ``standardize``, and the means for
    ``impute_mean``."""
    whole = state.groupBy("column").agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    spread = state.join(whole, "column").groupBy("column").agg(
        F.first("_mean").alias("mean"), F.sqrt(F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2) / F.first("_n")).alias("sd"))
    return {r["column"]: (r["mean"], r["sd"]) for r in spread.collect()}


def mode_state(df: DataFrame, cols: Iterable[str], by: str) -> DataFrame:
    """(``by``, column, value, n): how often each non-null number occurs."""
    values = df.select(F.col(f"`{by}`").alias(by), F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols])).alias("p")).select(by, "p.*")
    return values.where(F.col("value").isNotNull()).groupBy(by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def merge_modes(state: DataFrame) -> dict[str, float]:
    """The most frequent value of each column over all states, ties to the smallest; for ``impute_mode``."""
    counts = state.groupBy("column", "value").agg(F.sum("n").alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("m"))
    return {r["column"]: r["m"]["value"] for r in best.collect()}
