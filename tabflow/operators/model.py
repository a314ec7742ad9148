"""Distributed training and batch scoring.

The production booster is ``boosting.train_booster`` with all its settings;
the baseline puts it behind a Spark ML pipeline that prepares the features.
Both train as tree-level aggregation jobs on the executors (histograms per node are merged,
rows never leave their partition), and scoring is a narrow projection that
keeps every row, so predictions need no join back and no collect.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, Imputer, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.operators.boosting import BoostedTrees, register_function, train_booster
from tabflow.operators.checks import schema_from_json, schema_to_json
from tabflow.session import scratch_path, scratch_root, shuffle_partitions


# Production booster settings of the original model, and the
# baseline (auto-generated) booster settings.
PRODUCTION_PARAMS = {
    "colsample_bytree": 0.44577278777254614,
    "lambda_l1": 0.2266629157748783,
    "lambda_l2": 10.893970881329095,
    "learning_rate": 1.2449551085899786,
    "max_bin": 335,
    "max_depth": 6,
    "min_child_samples": 107,
    "n_estimators": 15,
    "num_leaves": 54,
    "path_smooth": 72.81495313163249,
    "subsample": 0.6725811904726468,
    "random_state": 685970732,
}
BASELINE_PARAMS = {
    "learning_rate": 0.008098213761399603,
    "max_depth": 8,
    "min_child_weight": 3,
    "subsample": 0.12038118521316003,
    "random_state": 520692802,
    "n_estimators": 100,
}
HASH_FEATURES = 4096


def baseline_settings(params: dict = BASELINE_PARAMS) -> dict:
    """The booster's settings for the baseline's: a sample of the rows for every
    tree, trees grown to ``max_depth`` without a limit on leaves or their rows,
    and what its library does by default: L2 of 1, 256 bins, a start at 0."""
    return {"lambda_l2": 1.0, "max_bin": 256, "min_child_samples": 0, "num_leaves": None, "subsample_freq": 1,
            "boost_from_average": False, **params}


def assemble(numeric: Sequence[str], output: str = "features", impute: bool = True,
             hashed: Sequence[str] = (), n_hash: int = HASH_FEATURES,
             hash_slots: Sequence[int] | None = None) -> list:
    """Stages that turn columns into one dense/sparse vector column.

    Numeric columns are mean-imputed first (the assembler rejects nulls, and
    ``handleInvalid='keep'`` would feed NaN to the trees). Text columns in
    ``hashed`` are hashed into ``n_hash`` slots after nulls become ''; with
    ``hash_slots`` only those slots are kept (see ``used_hash_slots``)."""
    numeric = list(numeric)
    stages: list = []
    cols = numeric
    if impute and numeric:
        imputed = [f"{c}__imp" for c in numeric]
        stages.append(Imputer(strategy="mean", inputCols=numeric, outputCols=imputed))
        cols = imputed
    inputs = list(cols)
    if hashed and (hash_slots is None or len(hash_slots) > 0):
        stages.append(FeatureHasher(inputCols=list(hashed), outputCol=f"{output}__hash", numFeatures=n_hash))
        if hash_slots is None:
            inputs.append(f"{output}__hash")
        else:
            stages.append(VectorSlicer(inputCol=f"{output}__hash", outputCol=f"{output}__slots",
                                       indices=sorted(int(i) for i in hash_slots)))
            inputs.append(f"{output}__slots")
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="error"))
    return stages


def used_hash_slots(df: DataFrame, hashed: Sequence[str], n_hash: int = HASH_FEATURES) -> list[int]:
    """Hash slots that are non-zero in at least one row (one aggregate of the
    sparse vectors; at most ``n_hash`` integers reach the driver).

    Trees cannot split on a slot that is zero in every training row, so
    dropping those slots leaves the model unchanged while MLlib's binning and
    per-level histograms shrink from ``n_hash`` features to the used ones."""
    h = FeatureHasher(inputCols=list(hashed), outputCol="_h", numFeatures=n_hash).transform(df)
    counts = h.select(Summarizer.numNonZeros(F.col("_h")).alias("n")).first()
    return [] if counts is None or counts.n is None else [i for i, v in enumerate(counts.n.toArray().tolist()) if v]


def _prepare(df: DataFrame, numeric: Sequence[str], label: str, hashed: Sequence[str] = ()) -> DataFrame:
    """Typed training frame (features, label), spread over the cluster.
    Callers persist it for the length of one fit: the imputer, the split
    finder and the booster each read it, and a lost cached block is simply
    recomputed from the lineage."""
    cols = [F.col(f"`{c}`").try_cast("double").alias(c) for c in numeric]
    cols += [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in hashed]
    return _spread(df.select(*cols, F.col(f"`{label}`").try_cast("double").alias("label")))


def _spread(df: DataFrame) -> DataFrame:
    """Training runs one task per input partition per tree level, and a fit
    depends on how rows are laid out. Rows are always dealt round-robin over
    ``spark.sql.shuffle.partitions``, whatever the input's files or the number
    of cores: immune to repeated rows (hashing whole rows would send a block of
    identical rows to one task), and deterministic on recomputation because
    Spark sorts each input partition before a round-robin repartition."""
    scratch_root(df.sparkSession)  # the boosting checkpoints need spark.checkpoint.dir
    return df.repartition(shuffle_partitions(df.sparkSession))


@dataclass
class TrainedModel:
    model: BoostedTrees
    features: list[str]
    label: str
    signature: str  # input schema JSON
    prepare: PipelineModel | None = None  # gives the vectors ("features") that the trees are of

    def transform(self, df: DataFrame) -> DataFrame:
        """df with ``prediction`` and ``probability`` (of the label 1)."""
        if self.prepare is None:
            return self.model.transform(df)
        return self.model.transform_vectors(self.prepare.transform(df), "features")


def train_production(train: DataFrame, features: Sequence[str], label: str,
                     params: dict = PRODUCTION_PARAMS) -> TrainedModel:
    """Second-order boosted trees with the production settings, missing values
    routed by the trees (``subsample`` has no frequency and is inactive)."""
    booster = train_booster(train, features, label, params)
    return TrainedModel(booster, booster.features, label, booster.signature)


def train_baseline(train: DataFrame, numeric: Sequence[str], label: str, hashed: Sequence[str] = (),
                   params: dict = BASELINE_PARAMS) -> TrainedModel:
    """Impute numeric, hash text ('' for null), assemble, standardise (one Spark
    ML pipeline), then second-order trees with the baseline's settings."""
    numeric, hashed = list(numeric), list(hashed)
    data = _prepare(train, numeric, label, hashed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        slots = used_hash_slots(data, hashed) if hashed else None
        stages = assemble(numeric, output="raw_features", hashed=hashed, hash_slots=slots)
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=not hashed, withStd=True))
        prepare = Pipeline(stages=stages).fit(data)
        names = [*numeric, *(f"slot {i}" for i in sorted(slots or []))]
        rows = prepare.transform(data).select("label", vector_to_array("features").alias("_x"))
        # written, as the booster reads its rows several times and the pipeline's stages cost more than a scan
        path = scratch_path(train.sparkSession, "prepared")
        rows.select("label", *[F.col("_x")[i].alias(f"x{i}") for i in range(len(names))]).write.parquet(path)
    finally:
        data.unpersist()
    wide = train.sparkSession.read.parquet(path).toDF("label", *names)
    booster = train_booster(wide, names, "label", baseline_settings(params))
    fields = [T.StructField(c, T.DoubleType()) for c in numeric] + [T.StructField(c, T.StringType()) for c in hashed]
    return TrainedModel(booster, numeric + hashed, label, schema_to_json(T.StructType(fields)), prepare)


def score(model: TrainedModel, df: DataFrame, keep: Sequence[str] | None = None,
          prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """Add an integer prediction and the positive-class probability to every
    row of ``df`` (all its columns kept unless ``keep`` says otherwise).
    Feature columns are cast to the model's signature types in place."""
    keep = list(df.columns if keep is None else keep)
    types = {f.name: f.dataType for f in schema_from_json(model.signature).fields}
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"input lacks model features {missing}")

    def typed(c: str):
        col = F.col(f"`{c}`")
        if isinstance(types[c], T.StringType):
            return F.coalesce(col.cast("string"), F.lit("")).alias(c)
        return col.try_cast("double").alias(c)

    src = df.select(*[typed(c) if c in types else F.col(f"`{c}`") for c in df.columns])
    out = model.transform(src)
    return out.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col("prediction").cast("int").alias(prediction),
        F.col("probability").alias(probability),
    )


_SAVED = "signature string, label string, features string, trees string, prepared boolean"


def save_model(model: TrainedModel, path: str) -> None:
    """The input signature and the trees to ``path/signature``, a preparing
    pipeline to ``path/prepare`` (through Spark, so any shared file system works)."""
    spark = SparkSession.getActiveSession()
    if model.prepare is not None:
        model.prepare.write().overwrite().save(f"{path}/prepare")
    meta = spark.createDataFrame([(model.signature, model.label, ",".join(model.features), model.model.to_json(), model.prepare is not None)], _SAVED)
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/signature")


def load_model(path: str) -> TrainedModel:
    spark = SparkSession.getActiveSession()
    meta = spark.read.schema(_SAVED).json(f"{path}/signature").first()
    prepare = PipelineModel.load(f"{path}/prepare") if meta["prepared"] else None
    return TrainedModel(BoostedTrees.from_json(meta["trees"]), meta["features"].split(","), meta["label"], meta["signature"], prepare)


def register_scoring(spark: SparkSession, model: TrainedModel, name: str, stage: str) -> str:
    """The SQL function ``<name>_<stage>`` of a model whose trees are of plain columns."""
    if model.prepare is not None:
        raise ValueError("a model with a preparing pipeline is not compiled to a SQL function")
    return register_function(spark, model.model, name, stage)


def hash_signed(df: DataFrame, cols: Sequence[str] | str, n_features: int = HASH_FEATURES, output: str = "hashed") -> DataFrame:
    """Hash text columns into ``n_features`` slots with signs: a sparse row as
    an array of (slot, value), ascending.

    The first 32 bits of a value's md5 choose its slot (modulo ``n_features``,
    after the top bit) and, by the top bit, its sign, so that values that meet
    in a slot cancel out on average instead of adding up. Null counts as ''.
    Slots whose signs add up to 0 are left out."""
    cols = [cols] if isinstance(cols, str) else list(cols)

    def one(c: str):
        bits = F.conv(F.substring(F.md5(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")
        return F.struct(((bits % 2**31) % n_features).cast("int").alias("slot"), F.when(bits >= 2**31, -1.0).otherwise(1.0).alias("value"))

    pairs = F.array(*[one(c) for c in cols])
    if len(cols) > 1:
        slots = F.array_sort(F.array_distinct(F.transform(pairs, lambda x: x["slot"])))
        summed = F.transform(slots, lambda k: F.struct(k.alias("slot"), F.aggregate(
            F.filter(pairs, lambda x: x["slot"] == k), F.lit(0.0), lambda total, x: total + x["value"]).alias("value")))
        pairs = F.filter(summed, lambda x: x["value"] != 0)
    return df.withColumn(output, pairs)


def hash_text(df: DataFrame, cols: Sequence[str] | str, n_features: int = HASH_FEATURES,
              output: str = "hashed") -> DataFrame:
    """Hash text columns into ``n_features`` slots (null -> ''), a sparse vector."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    filled = df.fillna("", subset=cols)
    return FeatureHasher(inputCols=cols, outputCol=output, numFeatures=n_features).transform(filled)
