"""Runs, model versions, stages and tags as append-only tables.

A tracking server and model registry are replaced by two event tables that a
Spark user can query and append to:

* runs: ``run_id, experiment_id, run_name, status, end_time,
  metrics map<string,double>, params map<string,string>,
  tags map<string,string>, deleted boolean``
* version events: ``seq, name, version, kind ('stage'|'tag'), to_stage,
  archive_existing, key, value``

Current state (stage, tags, version numbers) is derived at read time with
grouped aggregates (``max_by``), never by replaying events on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.operators.cumulative import row_numbers

# Registry stages, the check tags read by the gate, the values
# that fail a check, and the gate's status texts.
STAGES = ["None", "Staging", "Production", "Archived"]
CHECK_KEYS = ["predicts", "has_signature", "demo_test", "has_description", "has_artifacts"]
FAIL_VALUES = ["0", "fail"]
#: What the scheduled retraining notes on the versions it registers.
RETRAIN_COMMENT = "Registered by the scheduled retraining."
STATUS_KEY = "overall status"
STATUS_RELEASE = "May proceed to cut a release"
STATUS_PROD = "Clear for prod use"
STATUS_RECHECK = "Please check tags to reassess"
RUN_NAME_TAG = "run_name"

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("experiment_id", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("deleted", T.BooleanType()),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("to_stage", T.StringType()),
    T.StructField("archive_existing", T.BooleanType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])


# ---------------------------------------------------------------- runs

def run_row(spark: SparkSession, run_id: str, run_name: str, metrics: Mapping[str, float],
            params: Mapping[str, str] | None = None, tags: Mapping[str, str] | None = None,
            experiment_id: str = "0", status: str = "FINISHED",
            end_time: datetime | None = None) -> DataFrame:
    """One run as a one-row DataFrame, ready to append to the runs table."""
    tags = {RUN_NAME_TAG: run_name, **(tags or {})}
    row = (run_id, experiment_id, run_name, status, end_time or datetime.now(),
           {k: float(v) for k, v in metrics.items()}, {k: str(v) for k, v in (params or {}).items()},
           {k: str(v) for k, v in tags.items()}, False)
    return spark.createDataFrame([row], RUN_SCHEMA)


def log_run(spark: SparkSession, runs_table: str, **kw) -> str:
    """Append one run to the runs table; returns its id."""
    df = run_row(spark, **kw)
    df.write.mode("append").format("parquet").saveAsTable(runs_table)
    return kw["run_id"]


def append_runs(runs: DataFrame, runs_table: str) -> None:
    """Append a batch of runs (e.g. backfilled from another tracker) to the
    runs table; columns are matched by name to the runs schema."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_SCHEMA.fields]
    runs.select(*cols).write.mode("append").format("parquet").saveAsTable(runs_table)


def active_finished(runs: DataFrame, run_name: str | None = None) -> DataFrame:
    r = runs.where((F.col("status") == "FINISHED") & ~F.coalesce(F.col("deleted"), F.lit(False)))
    if run_name is not None:
        r = r.where(F.col("tags")[RUN_NAME_TAG] == F.lit(run_name))
    return r


def select_run(runs: DataFrame, metric: str = "test_accuracy_score", floor: float = 0.78,
               run_name: str | None = None) -> DataFrame:
    """The newest (by end time, ties by run id) active finished run whose
    metric is above ``floor``: one row, or none. A global ``max_by`` —
    partial per task, so only one candidate per task is shuffled."""
    m = F.col("metrics")[metric]
    cand = active_finished(runs, run_name).where(m > F.lit(floor))
    best = cand.agg(F.max_by(F.struct(F.col("run_id"), F.col("end_time"), m.alias(metric)),
                             F.struct("end_time", "run_id")).alias("b"))
    return best.where(F.col("b").isNotNull()).select("b.*")


def leaderboard(runs: DataFrame, metric: str = "val_f1_score", k: int = 10, run_name: str | None = None,
                ascending: bool = False) -> DataFrame:
    """Top-k active finished runs by a metric (TakeOrderedAndProject)."""
    m = F.col("metrics")[metric]
    r = active_finished(runs, run_name).where(m.isNotNull())
    return (r.select("run_id", "run_name", m.alias(metric))
             .orderBy(F.col(metric).asc() if ascending else F.col(metric).desc(), "run_id").limit(k))


# ---------------------------------------------------------------- versions

def register_event(spark: SparkSession, seq: int, name: str, version: int, kind: str,
                   to_stage: str | None = None, archive_existing: bool = False,
                   key: str | None = None, value: str | None = None) -> DataFrame:
    if to_stage is not None and to_stage.capitalize() not in STAGES:
        raise ValueError(f"unknown stage {to_stage!r}")
    stage = None if to_stage is None else to_stage.capitalize()
    return spark.createDataFrame([(seq, name, version, kind, stage, archive_existing, key, value)], EVENT_SCHEMA)


def model_tag(name: str, key: str, value: str) -> tuple:
    """The row of an event (without its number) that tags a model as such: one with no version."""
    return (name, None, "tag", None, False, key, value)


def _of_versions(events: DataFrame) -> DataFrame:
    return events.where(F.col("version").isNotNull())


def model_tags(events: DataFrame) -> DataFrame:
    """Last value per (model, key) of the tags that are of no version, such as
    the model's own description."""
    t = events.where((F.col("kind") == "tag") & F.col("version").isNull())
    return t.groupBy("name", "key").agg(F.max_by("value", "seq").alias("value"))


def versions(events: DataFrame) -> DataFrame:
    """Registered versions: first event per (name, version), numbered per
    model in registration order (``version_number`` = previous + 1)."""
    first = _of_versions(events).groupBy("name", "version").agg(F.min("seq").alias("registered_seq"))
    return row_numbers(first, ["registered_seq", "version"], ["name"], out="version_number")


def current_stage(events: DataFrame) -> DataFrame:
    """Stage of every registered version after all events.

    A version's own last stage event sets its stage; it is 'Archived' when a
    later stage change of another version of the same model into that same
    stage asked to archive existing versions. Equals a sequential replay."""
    stage_ev = events.where(F.col("kind") == "stage")
    own = stage_ev.groupBy("name", "version").agg(
        F.max_by(F.struct(F.col("seq").alias("stage_seq"), F.col("to_stage").alias("own_stage")), F.col("seq")).alias("o"))
    arch = (stage_ev.where(F.col("archive_existing"))
            .groupBy("name", F.col("to_stage").alias("own_stage"))
            .agg(F.max("seq").alias("archive_seq")))
    reg = _of_versions(events).groupBy("name", "version").agg(F.min("seq").alias("registered_seq"))
    o = reg.join(own.select("name", "version", "o.*"), ["name", "version"], "left")
    res = o.join(arch, ["name", "own_stage"], "left")
    stage = (F.when(F.col("own_stage").isNull(), F.lit("None"))
             .when(F.col("archive_seq") > F.col("stage_seq"), F.lit("Archived"))
             .otherwise(F.col("own_stage")))
    return res.select("name", "version", stage.alias("stage"),
                      F.coalesce("stage_seq", "registered_seq").alias("stage_seq"))


def latest_rows(stages: DataFrame, tags: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    """Newest version per (model, stage) with its run id and description, from
    the tables of current stages and current tags: one row a version travels
    on, so the event log is not read again for each of them."""
    own = tags.where(F.col("key").isin("run_id", "description")).groupBy("name", "version").agg(
        F.max(F.when(F.col("key") == "run_id", F.col("value"))).alias("run_id"),
        F.max(F.when(F.col("key") == "description", F.col("value"))).alias("description"))
    return latest_versions(stages, wanted).join(own, ["name", "version"], "left").select("name", "stage", "version", "run_id", "description")


def latest_versions(stages: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    """Newest version per (model, stage), optionally for some stages only."""
    s = stages if not wanted else stages.where(F.col("stage").isin([w.capitalize() for w in wanted]))
    return s.groupBy("name", "stage").agg(F.max("version").alias("version"))


def current_tags(events: DataFrame) -> DataFrame:
    """Last value per (name, version, key) — last write wins. Descriptions
    and review comments are tags with keys 'description' / 'comment'."""
    t = _of_versions(events).where(F.col("kind") == "tag")
    return t.groupBy("name", "version", "key").agg(F.max_by("value", "seq").alias("value"))


def tags_as_map(tags: DataFrame) -> DataFrame:
    """One row per version with a ``map<key, value>`` (for display/lookup)."""
    return tags.groupBy("name", "version").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("tags"))


def find_release(stages: DataFrame, tags: DataFrame, status: str = STATUS_RELEASE,
                 stage: str = "Staging") -> DataFrame:
    """Newest version per model whose current status tag equals ``status`` and
    whose current stage is ``stage``."""
    ok = tags.where((F.col("key") == STATUS_KEY) & (F.col("value") == status)).select("name", "version")
    st = stages.where(F.col("stage") == stage).select("name", "version")
    return ok.join(st, ["name", "version"]).groupBy("name").agg(F.max("version").alias("version"))


def gate(tags: DataFrame, stages: DataFrame, flow: str = "validation") -> DataFrame:
    """Per version with check tags: reject if any check is '0' or 'fail'.

    ``flow='validation'``: clear -> stage unchanged, reject -> Archived.
    ``flow='retrain'``:    clear -> Production, reject -> None.
    """
    checks = tags.where(F.col("key").isin(CHECK_KEYS))
    g = checks.groupBy("name", "version").agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.bool_or(F.col("value").isin(FAIL_VALUES)).alias("rejected"))
    g = g.join(stages.select("name", "version", "stage"), ["name", "version"], "left")
    if flow == "validation":
        clear_stage, reject_stage, clear_text = F.coalesce(F.col("stage"), F.lit("None")), F.lit("Archived"), STATUS_RELEASE
    elif flow == "retrain":
        clear_stage, reject_stage, clear_text = F.lit("Production"), F.lit("None"), STATUS_PROD
    else:
        raise ValueError(flow)
    return g.select(
        "name", "version", "n_checks", "rejected",
        F.when(F.col("rejected"), F.lit(STATUS_RECHECK)).otherwise(F.lit(clear_text)).alias("overall_status"),
        F.when(F.col("rejected"), reject_stage).otherwise(clear_stage).alias("next_stage"),
    )

