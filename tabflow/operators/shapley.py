"""Shapley feature importance as one Spark job (sampled feature orders).

For each example x, each background row b (at most ``max_background``,
drawn deterministically) and each of ``n_orders`` seeded feature orders, the
features are switched from b to x one at a time in that order; the model
scores every intermediate row once (``transform``), and the change of the
prediction is credited to the feature just switched. Averaging per
(example, feature) gives values that sum exactly to f(x) - mean f(b).

Rows per example = backgrounds x orders x (features + 1), bounded by the
parameters, never by the data; the background rows are a bounded sample held
as literals, so there is no join. Examples are spread over tasks like any
other rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.operators.checks import schema_from_json
from tabflow.operators.model import TrainedModel
from tabflow.operators.split import sample_n
from tabflow.session import shuffle_partitions


def _is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def mode_values(df: DataFrame, cols: Sequence[str]) -> dict[str, float | str | None]:
    """Most frequent value per column (ties: smallest value), one job: counts
    per (column, value) with map-side combine, then max_by. Text columns keep
    their text, all others are read as numbers."""
    cols = list(cols)
    text = {c for c in cols if _is_text(df.schema[c].dataType)}

    def pair(c: str) -> Column:
        v = F.col(f"`{c}`")
        return F.struct(F.lit(c).alias("c"), (F.lit(None) if c in text else v).cast("double").alias("v"),
                        (v if c in text else F.lit(None)).cast("string").alias("t"))

    pairs = df.select(F.explode(F.array(*[pair(c) for c in cols])).alias("p")).select("p.*")
    counts = pairs.where(F.col("v").isNotNull() | F.col("t").isNotNull()).groupBy("c", "v", "t").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("n"), "v", "t")).alias("m"))
    got = {r["c"]: r["m"]["t"] if r["c"] in text else r["m"]["v"] for r in best.collect()}
    return {c: got.get(c) for c in cols}


def _mode(values: list) -> float | str | None:
    """Most frequent value of a bounded list, ties to the smallest."""
    if not values:
        return None
    counts = Counter(values)
    return min(counts, key=lambda v: (-counts[v], v))


def impute_mode(df: DataFrame, cols: Sequence[str], modes: dict | None = None) -> DataFrame:
    modes = modes or mode_values(df, cols)
    return df.fillna({c: v for c, v in modes.items() if v is not None})


def shapley(
    model: TrainedModel,
    examples: DataFrame,
    background: DataFrame,
    key: str,
    n_orders: int = 20,
    max_background: int = 100,
    seed: int = 0,
    background_key: str | Sequence[str] | None = None,
    impute: bool = True,
) -> DataFrame:
    """Rows ``(key, feature, shap_value)`` for every example row.

    ``background`` is reduced to at most ``max_background`` rows with
    ``sample_n`` (deterministic); with ``impute``, nulls in background and
    examples are filled with the background's per-feature mode first."""
    feats = list(model.features)
    d = len(feats)
    bkey = background_key or key
    # one job: at most max_background rows reach the driver (a proven bound)
    text = {f.name for f in schema_from_json(model.signature).fields if isinstance(f.dataType, T.StringType)}
    rows = sample_n(background, max_background, bkey, seed=seed).select(*feats).collect()
    bg = [[None if r[c] is None else str(r[c]) if c in text else float(r[c]) for c in feats] for r in rows]
    n_bg = len(bg)
    if n_bg == 0:
        raise ValueError("empty background")
    if impute:
        modes = {c: _mode([row[i] for row in bg if row[i] is not None]) for i, c in enumerate(feats)}
        bg = [[modes[c] if v is None else v for v, c in zip(row, feats)] for row in bg]
        examples = examples.fillna({c: v for c, v in modes.items() if v is not None})

    rng = np.random.RandomState(seed)
    orders = [rng.permutation(d).tolist() for _ in range(n_orders)]
    pos = [[order.index(f) for f in range(d)] for order in orders]

    kind = lambda c: "string" if c in text else "double"
    bg_lit = [F.array(*[F.lit(row[f]).cast(kind(c)) for row in bg]) for f, c in enumerate(feats)]
    pos_lit = F.array(*[F.array(*[F.lit(p) for p in row]) for row in pos])
    ord_lit = F.array(*[F.array(*[F.lit(f) for f in row]) for row in orders])

    per_bk = n_orders * (d + 1)
    # an example has an id of its own: two of them may share a key
    ex = examples.select(F.col(f"`{key}`").alias("_key"), F.monotonically_increasing_id().alias("_id"),
                         *[F.col(f"`{c}`").cast(kind(c)).alias(c) for c in feats])
    ex = ex.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n_bg * per_bk - 1))))
    ex = ex.select("*",
                   (F.col("_i") / per_bk).cast("int").alias("_b"),
                   ((F.col("_i") / (d + 1)).cast("int") % n_orders).alias("_k"),
                   (F.col("_i") % (d + 1)).cast("int").alias("_j"))
    # one shuffle, of rows bounded by the parameters: it spreads the scoring and serves the window
    ex = ex.repartition(shuffle_partitions(examples.sparkSession), "_id", "_b", "_k")
    hybrid = ex.select(
        "_key", "_id", "_b", "_k", "_j",
        *[F.when(F.element_at(F.element_at(pos_lit, F.col("_k") + 1), f + 1) < F.col("_j"), F.col(c))
           .otherwise(F.element_at(bg_lit[f], F.col("_b") + 1)).alias(c)
          for f, c in enumerate(feats)])
    scored = model.transform(hybrid).select("_key", "_id", "_b", "_k", "_j", F.col("prediction").cast("double").alias("_f"))
    w = Window.partitionBy("_id", "_b", "_k").orderBy("_j")
    gains = (scored.withColumn("_gain", F.lead("_f").over(w) - F.col("_f"))
                   .where(F.col("_j") < d)
                   .withColumn("_feat", F.element_at(F.element_at(ord_lit, F.col("_k") + 1), F.col("_j") + 1)))
    names = F.array(*[F.lit(c) for c in feats])
    return (gains.groupBy("_id", "_key", "_feat").agg(F.avg("_gain").alias("shap_value"))
                 .select(F.col("_key").alias(key), F.element_at(names, F.col("_feat") + 1).alias("feature"),
                         "shap_value"))


def coalitions(d: int, most: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Coalitions of d features (0/1 rows, neither empty nor full) and their
    kernel weights, which sum to 1.

    All of them if there are at most ``most``. Otherwise whole sizes from the
    outside in (1 and d - 1, 2 and d - 2, ...), which weigh most, as long as
    they fit, and for the rest seeded draws with their complements, which
    share the weight that the sizes left have."""
    kernel = {k: (d - 1) / (k * (d - k)) for k in range(1, d)}  # of all coalitions of a size together
    rows, weights, left = [], [], []
    for k in range(1, d // 2 + 1):
        sizes = sorted({k, d - k})
        if not left and len(rows) + sum(comb(d, s) for s in sizes) <= most:
            for s in sizes:
                for chosen in combinations(range(d), s):
                    rows.append([int(i in chosen) for i in range(d)])
                    weights.append(kernel[s] / comb(d, s))
        else:
            left.append(k)
    if left:
        rng = np.random.RandomState(seed)
        share = np.array([sum(kernel[s] for s in {k, d - k}) for k in left])
        drawn: Counter = Counter()
        for _ in range(max(1, (most - len(rows)) // 2)):
            k = left[rng.choice(len(left), p=share / share.sum())]
            z = np.zeros(d, int)
            z[rng.choice(d, k, replace=False)] = 1
            drawn[tuple(z)] += 1
            drawn[tuple(1 - z)] += 1
        total = sum(drawn.values())
        rows += [list(z) for z in drawn]
        weights += [share.sum() * n / total for n in drawn.values()]
    w = np.array(weights, float)
    return np.array(rows, int).reshape(-1, d), w / w.sum() if len(w) else w


def kernel_shapley(
    model: TrainedModel,
    examples: DataFrame,
    background: DataFrame,
    key: str,
    max_coalitions: int | None = None,
    max_background: int = 100,
    seed: int = 0,
    background_key: str | Sequence[str] | None = None,
    impute: bool = True,
    output: str = "prediction",
) -> DataFrame:
    """Rows ``(key, feature, shap_value)`` by weighted least squares.

    For each example and coalition of features, the model's ``output`` is
    averaged over the background rows with the coalition's features set to the
    example's. The values are the linear model of coalitions that fits these
    averages best under the Shapley kernel's weights and sums exactly to
    f(x) - mean f(background). With all coalitions (at most ``max_coalitions``,
    2 x features + 2048 if None, as common explainers take) these are the
    exact Shapley values. Coalitions and background rows are literals, bounded
    by the parameters; the normal equations' right sides are summed per
    example, and their matrix is the same for all. Nulls are imputed as in
    ``shapley``; an empty background is an error."""
    feats = list(model.features)
    d = len(feats)
    text = {f.name for f in schema_from_json(model.signature).fields if isinstance(f.dataType, T.StringType)}
    rows = sample_n(background, max_background, background_key or key, seed=seed).select(*feats).collect()
    if not rows:
        raise ValueError("empty background")
    bg = [[None if r[c] is None else str(r[c]) if c in text else float(r[c]) for c in feats] for r in rows]
    if impute:
        modes = {c: _mode([row[i] for row in bg if row[i] is not None]) for i, c in enumerate(feats)}
        bg = [[modes[c] if v is None else v for v, c in zip(row, feats)] for row in bg]
        examples = examples.fillna({c: v for c, v in modes.items() if v is not None})
    z, w = coalitions(d, 2 * d + 2048 if max_coalitions is None else max_coalitions, seed)
    every = np.vstack([np.zeros((1, d), int), np.ones((1, d), int), z])  # none, all, the others
    n_bg = len(bg)
    kind = lambda c: "string" if c in text else "double"
    known = [F.array(*[F.lit(row[f]).cast(kind(c)) for row in bg]) for f, c in enumerate(feats)]
    member = [F.array(*[F.lit(bool(v)) for v in every[:, f]]) for f in range(d)]
    ex = examples.select(F.col(f"`{key}`").alias("_key"), F.monotonically_increasing_id().alias("_id"), *[F.col(f"`{c}`").cast(kind(c)).alias(c) for c in feats])
    ex = ex.withColumn("_z", F.explode(F.sequence(F.lit(0), F.lit(len(every) - 1)))).withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(n_bg - 1))))
    ex = ex.repartition(shuffle_partitions(examples.sparkSession), "_id", "_z")
    hybrid = ex.select("_key", "_id", "_z", *[F.when(F.element_at(member[f], F.col("_z") + 1), F.col(c)).otherwise(F.element_at(known[f], F.col("_b") + 1)).alias(c) for f, c in enumerate(feats)])
    mean = model.transform(hybrid).groupBy("_id", "_key", "_z").agg(F.avg(F.col(output).cast("double")).alias("_v"))
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in [0.0, 0.0, *w]]), F.col("_z") + 1)
    sums = mean.groupBy("_id", "_key").agg(
        F.max(F.when(F.col("_z") == 0, F.col("_v"))).alias("_none"), F.max(F.when(F.col("_z") == 1, F.col("_v"))).alias("_all"),
        *[F.sum(F.when(F.element_at(member[f], F.col("_z") + 1), weight * F.col("_v")).otherwise(0.0)).alias(f"_b{f}") for f in range(d)])
    gap = F.col("_all") - F.col("_none")
    if d == 1:
        values = [gap]
    else:
        # minimise sum w (v - none - z.phi)^2 with sum(phi) = gap: phi = inv(A) b + inv(A) 1 (gap - 1.inv(A) b) / 1.inv(A) 1
        inverse = np.linalg.pinv((z * w[:, None]).T @ z)
        lean, load = inverse.sum(axis=1), (z * w[:, None]).sum(axis=0)
        b = [F.col(f"_b{f}") - float(load[f]) * F.col("_none") for f in range(d)]
        free = [sum((float(inverse[f, k]) * b[k] for k in range(d)), F.lit(0.0)) for f in range(d)]
        miss = gap - sum(free, F.lit(0.0))
        values = [free[f] + float(lean[f] / lean.sum()) * miss for f in range(d)]
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), v.alias("shap_value")) for c, v in zip(feats, values)])
    return sums.select(F.col("_key").alias(key), F.explode(pairs).alias("p")).select(key, "p.feature", "p.shap_value")
