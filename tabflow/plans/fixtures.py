"""Inputs derived from the driver's tables (see FIXTURES.md §3).

Each function is a lazy projection / join of whole tables, so its work grows
with the data. The same derivations are written in DuckDB SQL by
``tabflow.plans.oracle`` for the correctness check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.operators.registry import RETRAIN_COMMENT, STATUS_RECHECK, STATUS_RELEASE
from tabflow.sources.files import read_parquet

# Derivation constants of FIXTURES.md §3: run status per order status, stage
# per event type, tag key by (k mod 8), and the texts of the version events.
# The two status texts are the gate's (see operators/registry.py).
RUN_STATUS = {"F": "FINISHED", "O": "RUNNING", "P": "FAILED"}
EVENT_STAGE = {"view": "None", "click": "Staging", "purchase": "Production", "error": "Archived"}
TAG_KEYS = ["predicts", "has_signature", "demo_test", "has_description", "has_artifacts",
            "overall status", "description", "comment"]
RELEASE_OK = STATUS_RELEASE
RELEASE_RECHECK = STATUS_RECHECK
DESCRIPTION_TEXT = "This model predicts attrition from order features."
COMMENT_TEXT = RETRAIN_COMMENT
METRIC_SCALE = 600000.0
RUN_NAME = "1-URGENT"

TRAIN_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: str, mapping: dict) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(col) == k, v) if expr is None else expr.when(F.col(col) == k, v)
    return expr


def attrition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as attrition-like rows: key o_orderkey, categoricals
    o_orderstatus / o_orderpriority, numeric o_totalprice."""
    return table(spark, sf_dir, "orders")


def orders_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with o_totalprice and o_orderpriority nulled where status = 'P'."""
    o = table(spark, sf_dir, "orders")
    is_p = F.col("o_orderstatus") == "P"
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(is_p, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(is_p, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined to labels: label = quality, prediction = n_chars > 1000,
    score = n_chars, slices toxic and lang."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id").select(
        "doc_id", "lang", "toxic",
        F.col("quality").alias("label"),
        (F.col("n_chars") > 1000).cast("int").alias("prediction"),
        F.col("n_chars").cast("double").alias("score"),
    )


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: four numeric features, label l_returnflag = 'R'."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", *TRAIN_FEATURES,
                     (F.col("l_returnflag") == "R").cast("int").alias("label"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as tracking runs (schema of FIXTURES.md §1, 'Runs')."""
    o = table(spark, sf_dir, "orders")
    metric = F.col("o_totalprice") / F.lit(METRIC_SCALE)
    return o.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_custkey").cast("string").alias("experiment_id"),
        F.col("o_orderpriority").alias("run_name"),
        _case("o_orderstatus", RUN_STATUS).alias("status"),
        F.col("o_orderdate").alias("end_time"),
        F.create_map(F.lit("test_accuracy_score"), metric,
                     F.lit("val_f1_score"), F.lit(1.0) - metric).alias("metrics"),
        F.create_map(F.lit("max_depth"), F.lit("6"), F.lit("n_estimators"), F.lit("15")).alias("params"),
        F.create_map(F.lit("run_name"), F.col("o_orderpriority"),
                     F.lit("db_table"), F.lit("features.orders"),
                     F.lit("demographic_vars"), F.lit("toxic,lang")).alias("tags"),
        ((F.col("o_custkey") % 13) == 0).alias("deleted"),
    )


def version_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as an append-only log of model-version stage changes and tags."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    is_tag = F.col("event_type") == "signup"
    key = F.element_at(F.array(*[F.lit(x) for x in TAG_KEYS]), (k % 8 + 1).cast("int"))
    hi = F.col("value") >= 5
    value = (
        F.when(key.isin("predicts", "has_signature", "has_description", "has_artifacts"),
               F.when(hi, "1").otherwise("0"))
        .when(key == "demo_test", F.when(hi, "pass").otherwise("fail"))
        .when(key == "overall status", F.when(F.col("value") >= 10, RELEASE_OK).otherwise(RELEASE_RECHECK))
        .when(key == "description", F.lit(DESCRIPTION_TEXT).substr(F.lit(1), k % 40))
        .otherwise(F.lit(COMMENT_TEXT))
    )
    stage = _case("event_type", EVENT_STAGE)
    return e.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("m"), (F.col("user_id") % 10).cast("string")).alias("name"),
        F.col("user_id").alias("version"),
        F.when(is_tag, "tag").otherwise("stage").alias("kind"),
        F.when(is_tag, F.lit(None).cast("string")).otherwise(stage).alias("to_stage"),
        (~is_tag & ((F.col("event_id") % 3) == 0) & F.col("event_type").isin("click", "purchase")).alias("archive_existing"),
        F.when(is_tag, key).alias("key"),
        F.when(is_tag, value).alias("value"),
    )


def model_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log with its comments and descriptions on the models instead of their versions."""
    own = (F.col("kind") == "tag") & F.col("key").isin("description", "comment")
    return version_events(spark, sf_dir).withColumn("version", F.when(~F.coalesce(own, F.lit(False)), F.col("version")))
