"""The end-to-end flows: raw file -> feature table -> train -> register ->
validate and gate -> promote -> batch score -> monthly retrain.

Each flow composes operators into lazy plans; the only values that reach
the driver are category lists, one metric row per evaluation and the one
chosen run / version row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.functions import columns as fc
from tabflow.operators import checks, metrics, model, registry, split
from tabflow.operators.encode import OneHot, OneHotModel
from tabflow.sources import files, tables
from tabflow.sources.log import Log


def compute_features(
    df: DataFrame,
    categorical: Sequence[str],
    label: str,
    label_map: Mapping[str, int] = fc.YES_NO,
    label_out: str = "churn",
    encoder: OneHotModel | None = None,
    strict: bool = False,
    numeric_text: Sequence[str] = (),
) -> tuple[DataFrame, OneHotModel]:
    """One-hot the categoricals, map the label to 0/1 (other values -> null)
    and rename it, clean column names, drop rows with any null.

    Default order follows the original flow: nulls are dropped while
    ``numeric_text`` columns are still text, so blank amounts survive and
    become null later (imputed before training). ``strict=True`` casts them
    to double first, so such rows are dropped."""
    enc = encoder or OneHot(categorical).fit(df)
    out = enc.transform(df)
    if strict and numeric_text:
        out = fc.to_double(out, numeric_text)
    out = fc.map_label(out, label, label_map, out=label_out)
    out = fc.clean_names(out)
    out = fc.drop_nulls(out)
    return out, enc


# ---------------------------------------------------------------- flows



@dataclass
class Workspace:
    """Where a model's tables live: a database holding ``runs``, the log of
    version events in the database's folder (``version_events``; any number of
    jobs may write to it at once), and a shared folder for saved models, by
    default one in the database's folder, too."""
    spark: SparkSession
    db: str = "tabflow"
    model_root: str = field(default="")

    def __post_init__(self):
        tables.ensure_database(self.spark, self.db)
        home = self.spark.catalog.getDatabase(self.db).locationUri.rstrip("/")
        self.log = Log(self.spark, f"{home}/version_events", registry.EVENT_SCHEMA)
        if not self.model_root:
            self.model_root = f"{home}/_models"

    @property
    def runs_table(self) -> str:
        return f"{self.db}.runs"

    def runs(self) -> DataFrame:
        if not self.spark.catalog.tableExists(self.runs_table):
            return self.spark.createDataFrame([], registry.RUN_SCHEMA)
        return self.spark.table(self.runs_table)

    def events(self) -> DataFrame:
        return self.log.read()

    def append_events(self, rows: list[tuple]) -> None:
        """Append (name, version, kind, to_stage, archive_existing, key, value) rows."""
        self.log.commit(lambda events: rows)


def ingest_csv(spark: SparkSession, path: str, table: str, schema=None, location: str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Raw CSV -> bronze table: fixed schema (columns by position, bad
    numbers -> null) or inferred types; managed, or external at ``location``."""
    df = files.read_csv_fixed(spark, path, schema) if schema is not None else files.read_csv_inferred(spark, path)
    if location:
        tables.write_external_table(spark, df, table, location, fmt)
    else:
        tables.write_table(df, table, fmt)
    return spark.table(table)


def build_features(spark: SparkSession, source: DataFrame, target: str, categorical: Sequence[str],
                   label: str, key: str, label_map: Mapping[str, int] = fc.YES_NO, label_out: str = "churn",
                   description: str = "", refit: bool = False) -> OneHotModel:
    """Raw table -> feature table (checked key, description, category list
    stored as a table property). A rebuild uses the stored list, so a month
    without some value keeps its column; ``refit`` learns it anew."""
    encoder = None
    if not refit and spark.catalog.tableExists(target):
        stored = tables.table_properties(spark, target).get("categories")
        if stored and set(json.loads(stored)) == set(categorical):
            encoder = OneHot.from_categories(json.loads(stored))
    feats, enc = compute_features(source, categorical, label, label_map, label_out, encoder=encoder)
    tables.write_feature_table(spark, feats, target, key, description)
    tables.set_properties(spark, target, {"categories": json.dumps(enc.categories)})
    return enc


def feature_columns(df: DataFrame, label: str, key: Sequence[str] | str, ignore: Sequence[str] = ()) -> list[str]:
    """Every column except the label, the key and ``ignore``. They must be
    numeric or boolean: text amounts are converted with ``numeric_text`` first,
    and a column of another type raises unless it is ignored by name."""
    drop = {label, *ignore, *([key] if isinstance(key, str) else key)}
    kept = [f for f in df.schema.fields if f.name not in drop]
    odd = [f.name for f in kept if not isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    if odd:
        raise ValueError(f"columns that are not numeric: {odd}; name them in numeric_text or ignore")
    return [f.name for f in kept]


# Metric names a classifier evaluation logs for a run (the
# public tracking API's names), from our metric columns.
LOGGED_NAMES = {"n": "example_count", "tp": "true_positives", "fp": "false_positives",
                "tn": "true_negatives", "fn": "false_negatives", "pr_auc": "precision_recall_auc"}


def _metric_rows(scored: DataFrame, label: str, prefixes: Mapping[str, str]) -> dict[str, float]:
    """The classifier metrics of each split, named as a run logs them, from
    one scoring pass; ``prefixes`` by split."""
    out: dict[str, float] = {}
    for row in metrics.evaluate(scored, label, by="_split").collect():  # a row per split
        m = row.asDict()
        prefix = prefixes[m.pop("_split")]
        out.update({f"{prefix}{LOGGED_NAMES.get(k, k)}": float(v) for k, v in m.items() if v is not None})
    return out


def train(ws: Workspace, feature_table: str, label: str, key: Sequence[str] | str, run_name: str,
          test_share: float = 0.2, seed: int = 0, params: dict | None = None,
          demographic_vars: str = "", numeric_text: Sequence[str] = (), ignore: Sequence[str] = ()) -> str:
    """Hash split -> fit -> training_/test_ metrics -> save pipeline -> log run.
    The settings that later flows need again are kept in the run's tags."""
    feats = fc.to_double(ws.spark.table(feature_table), numeric_text) if numeric_text else ws.spark.table(feature_table)
    cols = feature_columns(feats, label, key, ignore)
    marked = split.hash_split(feats, key, test_share, seed, out="_split")
    tr = marked.where(F.col("_split") == "train").drop("_split")
    m = model.train_production(tr, cols, label, params or model.PRODUCTION_PARAMS)
    run_id = uuid.uuid4().hex
    mets = _metric_rows(model.score(m, marked, keep=[label, "_split"]), label, {"train": "training_", "test": "test_"})
    model.save_model(m, f"{ws.model_root}/{run_id}")
    tags = {"db_table": feature_table, "demographic_vars": demographic_vars,
            "model_path": f"{ws.model_root}/{run_id}", "label": label,
            "key": ",".join([key] if isinstance(key, str) else key),
            "numeric_text": ",".join(numeric_text), "ignore": ",".join(ignore),
            "test_share": str(test_share), "seed": str(seed)}
    registry.log_run(ws.spark, ws.runs_table, run_id=run_id, run_name=run_name, metrics=mets,
                     params={k: str(v) for k, v in (params or model.PRODUCTION_PARAMS).items()}, tags=tags,
                     end_time=datetime.now())
    return run_id


def _listed(tags: Mapping[str, str], name: str) -> list[str]:
    return [c for c in (tags.get(name) or "").split(",") if c]


def _features(ws: Workspace, tags: Mapping[str, str], table: str | None = None) -> DataFrame:
    """A run's feature table as the run read it: text amounts as numbers."""
    feats = ws.spark.table(table or tags.get("db_table") or "")
    amounts = [c for c in _listed(tags, "numeric_text") if c in feats.columns]
    return fc.to_double(feats, amounts) if amounts else feats


def run_info(ws: Workspace, run_id: str) -> dict:
    r = ws.runs().where(F.col("run_id") == run_id).first()
    if r is None:
        raise KeyError(run_id)
    return r.asDict()


def register(ws: Workspace, run_id: str, name: str, description: str = "", to_stage: str = "Staging",
             archive_existing: bool = False, comment: str = "", model_description: str = "") -> int:
    """New version = previous + 1 for the model, also with several jobs that
    register at once; registered (stage None), described, optionally commented,
    then moved to ``to_stage``. ``model_description`` is of all versions."""
    def rows(events: DataFrame) -> list[tuple]:
        version = (events.where(F.col("name") == name).agg(F.max("version")).first()[0] or 0) + 1
        out = [(name, version, "stage", "None", False, None, None),
               (name, version, "tag", None, False, "run_id", run_id),
               (name, version, "tag", None, False, "description", description)]
        if model_description:
            out.append(registry.model_tag(name, "description", model_description))
        if comment:
            out.append((name, version, "tag", None, False, "comment", comment))
        if to_stage:
            out.append((name, version, "stage", to_stage.capitalize(), archive_existing, None, None))
        return out

    return ws.log.commit(rows)[0][1]


def describe_model(ws: Workspace, name: str, description: str) -> None:
    """The description of a model as such, beside those of its versions."""
    ws.append_events([registry.model_tag(name, "description", description)])


def _version_state(ws: Workspace, name: str, version: int) -> tuple[str, dict]:
    ev = ws.events().where((F.col("name") == name) & (F.col("version") == version))
    stage = registry.current_stage(ws.events().where(F.col("name") == name)) \
        .where(F.col("version") == version).first()
    tags = {r.key: r.value for r in registry.current_tags(ev).collect()}
    return (stage.stage if stage else "None"), tags


def validate(ws: Workspace, name: str, version: int | None = None, stage: str = "Staging",
             flow: str = "validation", holdout: bool = False, floor: float = metrics.SLICE_FLOOR) -> dict:
    """Checks on one version, written as tags; then the gate decides.

    predicts (C3), has_signature (C2), demo_test (A3 + A7), has_description
    (P9). ``holdout=True`` computes slice accuracy on the test part only."""
    if version is None:
        lv = registry.latest_versions(registry.current_stage(ws.events()), [stage]) \
            .where(F.col("name") == name).first()
        if lv is None:
            raise LookupError(f"no {stage} version of {name}")
        version = lv.version
    _, vtags = _version_state(ws, name, version)
    info = run_info(ws, vtags["run_id"])
    rtags = info["tags"]
    m = model.load_model(rtags["model_path"])
    label, key = rtags["label"], rtags["key"].split(",")
    feats = _features(ws, rtags)
    if holdout:
        feats = split.hash_split(feats, key, float(rtags.get("test_share") or 0.2), int(rtags.get("seed") or 0), out="_split").where(F.col("_split") == "test").drop("_split")
    demo = [c.strip() for c in (rtags.get("demographic_vars") or "").split(",") if c.strip()]
    # the model carries a signature and the input has every signature column in a type that fits
    signed = bool(m.signature) and bool(checks.schema_from_json(m.signature).fields)
    results = {"has_signature": "1" if signed and not checks.signature_faults(feats, m.signature) else "0"}
    try:
        scored = model.score(m, feats, keep=[label, *demo])
        # one pass over the scored table: per slice (null slice keys included)
        # rows, predicted rows and correct rows; both checks reduce that table
        flagged = fc.flag_correct(scored, label, "prediction")
        per = flagged.groupBy(*demo).agg(F.count(F.lit(1)).alias("obs"), F.count("prediction").alias("n_pred"),
                                         F.sum("accurate").alias("acc"))
        keyed = F.lit(True)
        for c in demo:
            keyed = keyed & F.col(c).isNotNull()
        row = per.agg(F.sum("obs").alias("n"), F.sum("n_pred").alias("n_pred"),
                      F.count(F.when(keyed, 1)).alias("n_slices"),
                      F.min(F.when(keyed, F.col("acc") / F.col("obs"))).alias("min_pct")).first()
    except (AnalysisException, ValueError):  # the model and its input don't fit; a failing cluster is no verdict on a model
        results.update(predicts="0", demo_test="fail" if demo else "none")
    else:
        results["predicts"] = "1" if (row.n or 0) == (row.n_pred or 0) else "0"
        if not demo or row.n_slices == 0:
            results["demo_test"] = "none"
        else:
            results["demo_test"] = "pass" if row.min_pct > floor else "fail"
    desc = vtags.get("description") or ""
    results["has_description"] = "1" if len(desc) > 20 else "0"
    ws.append_events([(name, version, "tag", None, False, k, v) for k, v in results.items()])
    decision = registry.gate(registry.current_tags(ws.events().where(F.col("name") == name)),
                             registry.current_stage(ws.events().where(F.col("name") == name)), flow=flow) \
        .where(F.col("version") == version).first().asDict()
    rows = [(name, version, "tag", None, False, registry.STATUS_KEY, decision["overall_status"])]
    cur, _ = _version_state(ws, name, version)
    if decision["next_stage"] != cur:
        rows.append((name, version, "stage", decision["next_stage"], False, None, None))
    ws.append_events(rows)
    return {"version": version, **results, **decision}


def promote(ws: Workspace, name: str, n_rows: int = 10) -> int | None:
    """Newest Staging version cleared for release: smoke-score ``n_rows``
    rows; on success tag it and move it to Production (archiving others)."""
    ev = ws.events().where(F.col("name") == name)
    rel = registry.find_release(registry.current_stage(ev), registry.current_tags(ev)).first()
    if rel is None:
        return None
    version = rel.version
    _, vtags = _version_state(ws, name, version)
    rtags = run_info(ws, vtags["run_id"])["tags"]
    m = model.load_model(rtags["model_path"])
    feats = _features(ws, rtags)
    smoke = split.smoke_rows(feats, n_rows, rtags["key"].split(","))
    ok = checks.check_predicts(model.score(m, smoke, keep=[rtags["label"]])).first().predicts == 1
    if ok:
        ws.append_events([(name, version, "tag", None, False, "predicts", "1"),
                          (name, version, "tag", None, False, registry.STATUS_KEY, registry.STATUS_PROD),
                          (name, version, "stage", "Production", True, None, None)])
    else:
        ws.append_events([(name, version, "tag", None, False, "predicts", "0")])
    return version if ok else None


def score_batch(ws: Workspace, name: str, predictions_table: str, batch_id: str,
                feature_table: str | None = None) -> dict:
    """Score the feature table with the newest Production version and write
    the batch to the predictions table (a re-run replaces its batch).
    Returns the batch accuracy. A scoring failure writes nothing."""
    lv = registry.latest_versions(registry.current_stage(ws.events()), ["Production"]) \
        .where(F.col("name") == name).first()
    if lv is None:
        raise LookupError(f"no Production version of {name}")
    _, vtags = _version_state(ws, name, lv.version)
    rtags = run_info(ws, vtags["run_id"])["tags"]
    m = model.load_model(rtags["model_path"])
    source = feature_table or rtags.get("db_table")
    feats = _features(ws, rtags, source)
    scored = model.score(m, feats, keep=feats.columns, prediction="predictions", probability="probability")
    tables.append_predictions(scored, predictions_table, batch_id=batch_id)
    written = ws.spark.table(predictions_table).where(F.col("batch_id") == batch_id)
    acc = metrics.accuracy(written, rtags["label"], "predictions").first()
    return {"version": lv.version, "rows": acc.n, "accuracy": acc.accuracy}


def retrain(ws: Workspace, feature_table: str, name: str, label: str, key: Sequence[str] | str,
            run_name: str, description: str, demographic_vars: str = "", params: dict | None = None,
            numeric_text: Sequence[str] | None = None, ignore: Sequence[str] | None = None) -> dict:
    """Monthly retrain: train -> register -> Staging (archive existing) ->
    comment -> checks -> gate: clear -> Production, reject -> None. What is
    not given is as in the run of the model's newest version."""
    tags: Mapping[str, str] = {}
    last = ws.events().where(F.col("name") == name).agg(F.max("version")).first()[0]
    if last is not None:
        _, vtags = _version_state(ws, name, last)
        tags = run_info(ws, vtags["run_id"])["tags"]
    given = {"numeric_text": _listed(tags, "numeric_text") if numeric_text is None else numeric_text,
             "ignore": _listed(tags, "ignore") if ignore is None else ignore,
             "test_share": float(tags.get("test_share") or 0.2), "seed": int(tags.get("seed") or 0)}
    run_id = train(ws, feature_table, label, key, run_name, params=params, demographic_vars=demographic_vars, **given)
    version = register(ws, run_id, name, description, "Staging", archive_existing=True, comment=registry.RETRAIN_COMMENT)
    res = validate(ws, name, version, flow="retrain")
    return {"run_id": run_id, **res}


def register_best(ws: Workspace, name: str, run_name: str | None = None, metric: str = "test_accuracy_score",
                  floor: float = 0.78, description: str = "", **settings) -> int | None:
    """Register the newest finished run whose metric is above the floor, for
    when no run id is at hand; None if there is no such run."""
    best = registry.select_run(ws.runs(), metric, floor, run_name).first()
    return register(ws, best.run_id, name, description, **settings) if best else None


# the flow names of the build plan
validate_and_gate = validate
