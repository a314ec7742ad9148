"""
driver tables (or inputs Spark derives from them). ``tabflow.plans.oracle``
holds the matching DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.functions import columns as fc
from tabflow.operators import boosting, checks, encode, metrics, model, registry, scale, split, state
from tabflow.operators.encode import OneHot
from tabflow.operators.scale import impute_mean, standardize
from tabflow.operators.shapley import impute_mode, kernel_shapley, shapley
from tabflow.plans import fixtures as fx
from tabflow.plans import jobs
from tabflow.session import scratch_path, scratch_root, unique_name
from tabflow.sources import files, tables
from tabflow.streaming.scoring import score_stream

Query = Callable[[SparkSession, str], DataFrame]

# The schema contract the customer table is checked against in the
# ``check_schema`` query (one column missing from the table, one with a
# different type).
CUSTOMER_CONTRACT = T.StructType([
    T.StructField("c_custkey", T.LongType(), False),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.LongType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_phone", T.StringType()),
])


QUERY_DB = "tabflow_queries"


def _table(spark, prefix: str) -> str:
    """A fresh table name in a database kept under the scratch root, so the
    writing queries do not depend on the working directory's warehouse."""
    tables.ensure_database(spark, QUERY_DB, f"{scratch_root(spark).rstrip('/')}/{QUERY_DB}.db")
    return f"{QUERY_DB}.{unique_name(prefix)}"


def _r(c: str, digits: int = 6):
    return F.round(F.col(c), digits).alias(c)


# ------------------------------------------------------------ features

def q_one_hot(spark, sf):
    o = fx.attrition_rows(spark, sf)
    return fc.clean_names(OneHot(["o_orderstatus", "o_orderpriority"]).fit(o).transform(o))


def q_label_map(spark, sf):
    o = fx.attrition_rows(spark, sf).select("o_orderkey", "o_orderstatus")
    return fc.map_label(o, "o_orderstatus", {"F": 1, "O": 0}, out="churn")


def q_drop_nulls(spark, sf):
    o = fx.attrition_rows(spark, sf).select("o_orderkey", "o_totalprice", "o_orderstatus")
    return fc.drop_nulls(fc.map_label(o, "o_orderstatus", {"F": 1, "O": 0}, out="churn"))


def q_build_features(spark, sf):
    return jobs.compute_features(fx.attrition_rows(spark, sf), categorical=["o_orderpriority"],
                                 label="o_orderstatus", label_map={"F": 1, "O": 0})[0]


def q_to_double(spark, sf):
    o = fx.attrition_rows(spark, sf).select(
        "o_orderkey", F.col("o_orderpriority").alias("priority_num"),
        F.substring("o_orderpriority", 1, 1).alias("priority_digit"))
    return fc.to_double(o, ["priority_num", "priority_digit"])


def q_impute_mean(spark, sf):
    o = fx.orders_with_nulls(spark, sf).select("o_orderkey", "o_totalprice")
    return impute_mean(o, ["o_totalprice"]).select("o_orderkey", _r("o_totalprice"))


def q_fill_constant(spark, sf):
    o = fx.orders_with_nulls(spark, sf).select("o_orderkey", "o_orderpriority")
    return fc.fill_constant(o, "o_orderpriority", "")


def q_impute_mode(spark, sf):
    o = fx.orders_with_nulls(spark, sf).select("o_orderkey", "o_totalprice")
    return impute_mode(o, ["o_totalprice"])


def q_standardize(spark, sf):
    c = fx.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return standardize(c, ["c_acctbal"]).select("c_custkey", _r("c_acctbal"))


def q_drop_label_key(spark, sf):
    """The feature columns of the attrition table: neither label nor key."""
    feats = q_build_features(spark, sf)
    return feats.select(*[F.col(f"`{c}`") for c in jobs.feature_columns(feats, "churn", "o_orderkey", ignore=["o_orderdate"])])


def q_encode_categories(spark, sf):
    """orders with customer and priority as places in a one-hot vector that is
    as long as there are customers and priorities."""
    o = fx.attrition_rows(spark, sf).select("o_orderkey", "o_custkey", "o_orderpriority")
    names = ["o_custkey", "o_orderpriority"]
    coded = encode.encode_sparse(o, encode.category_table(o, names), names)
    return coded.select("o_orderkey", F.get("indices", F.lit(0)).alias("customer_place"), F.get("indices", F.lit(1)).alias("priority_place"), "n_features")


def q_impute_mean_merged(spark, sf):
    """impute_mean from the stored moments of each order month."""
    o = fx.orders_with_nulls(spark, sf).withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    name = _table(spark, "moments")
    tables.write_table(scale.moment_state(o, ["o_totalprice"], "month"), name)
    means = {c: m for c, (m, _) in scale.merge_moments(tables.read_table(spark, name)).items()}
    return impute_mean(o, ["o_totalprice"], means).select("o_orderkey", _r("o_totalprice"))


def q_standardize_merged(spark, sf):
    """standardize from the moments of each nation's customers."""
    c = fx.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    stats = scale.merge_moments(scale.moment_state(c, ["c_acctbal"], "c_nationkey"))
    return standardize(c, ["c_acctbal"], stats).select("c_custkey", _r("c_acctbal"))


def q_impute_mode_merged(spark, sf):
    """impute_mode from the value counts of each order month."""
    o = fx.orders_with_nulls(spark, sf).withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    modes = scale.merge_modes(scale.mode_state(o, ["o_totalprice"], "month"))
    return impute_mode(o.select("o_orderkey", "o_totalprice"), ["o_totalprice"], modes)


# ------------------------------------------------------------ splits

def q_hash_split(spark, sf):
    c = fx.table(spark, sf, "customer").select("c_custkey")
    return split.hash_split(c, "c_custkey", 0.2, seed=0, bucket_col="bucket")


def q_stratified_split(spark, sf):
    lab = fx.table(spark, sf, "labels").select("doc_id", "quality")
    return split.stratified_split(lab, "quality", "doc_id", 0.25, seed=520692802)


def q_sample_n(spark, sf):
    return split.sample_n(fx.table(spark, sf, "customer"), 100, "c_custkey", seed=0)


def q_smoke_rows(spark, sf):
    return split.smoke_rows(fx.table(spark, sf, "customer"), 10, "c_custkey")


# ------------------------------------------------------------ metrics

def q_flag_correct(spark, sf):
    s = fx.scored_rows(spark, sf)
    return fc.flag_correct(s, "label", "prediction").select("doc_id", "label", "prediction", "accurate")


def q_accuracy(spark, sf):
    return metrics.accuracy(fx.scored_rows(spark, sf), "label", "prediction").select("n", "n_correct", _r("accuracy"))


def _slices(spark, sf):
    s = fc.flag_correct(fx.scored_rows(spark, sf), "label", "prediction")
    return metrics.slice_accuracy(s, "toxic,lang")


def q_slice_accuracy(spark, sf):
    return _slices(spark, sf).select("toxic", "lang", "acc", "obs", _r("pct_acc"))


def q_slice_gate(spark, sf):
    return metrics.slice_gate(_slices(spark, sf)).select("demo_test", "n_slices", _r("min_pct_acc"))


def q_binary_metrics(spark, sf):
    m = metrics.binary_metrics(fx.scored_rows(spark, sf), "label", "prediction")
    return m.select("n", "tp", "fp", "tn", "fn", *[_r(c) for c in
                    ("accuracy_score", "precision_score", "recall_score", "f1_score")])


def q_roc_auc(spark, sf):
    return metrics.roc_auc(fx.scored_rows(spark, sf), "label", "score").select(_r("roc_auc"))


def q_pr_auc(spark, sf):
    return metrics.pr_auc(fx.scored_rows(spark, sf), "label", "score").select(_r("pr_auc"))


# ------------------------------------------------------------ runs / versions

def _with_probability(spark, sf):
    """scored rows with the share n_chars / (n_chars + 1000) as probability."""
    s = fx.scored_rows(spark, sf)
    return s.withColumn("probability", F.col("score") / (F.col("score") + 1000.0))


def q_log_loss(spark, sf):
    return metrics.binary_metrics(_with_probability(spark, sf), "label", "prediction", "probability").select("n", _r("log_loss"))


def q_evaluate(spark, sf):
    """All classifier metrics per language in one pass over the scored rows."""
    e = metrics.evaluate(_with_probability(spark, sf), "label", by="lang")
    return e.select("lang", "n", "tp", "fp", "tn", "fn", *[_r(c) for c in (
        "accuracy_score", "precision_score", "recall_score", "f1_score", "log_loss", "roc_auc", "pr_auc")])


def q_hash_signed(spark, sf):
    """p_type hashed into 4096 signed slots, one per value."""
    p = model.hash_signed(fx.table(spark, sf, "part").select("p_partkey", "p_type"), "p_type")
    return p.select("p_partkey", "p_type", F.size("hashed").alias("n_slots"), F.col("hashed")[0]["slot"].alias("slot"), F.col("hashed")[0]["value"].alias("value"))


def q_log_runs(spark, sf):
    """Runs appended to a run table (twice: a table only grows), read back."""
    name = _table(spark, "runs")
    r = fx.runs(spark, sf)
    registry.append_runs(r.where(F.col("status") == "FINISHED"), name)
    registry.append_runs(r.where(F.col("status") != "FINISHED"), name)
    back = tables.read_table(spark, name)
    return back.select("run_id", "status", "end_time", "deleted",
                       F.col("metrics")["test_accuracy_score"].alias("test_accuracy_score"),
                       F.col("tags")[registry.RUN_NAME_TAG].alias("run_name"))


def q_select_run(spark, sf):
    r = registry.select_run(fx.runs(spark, sf), "test_accuracy_score", 0.78, run_name=fx.RUN_NAME)
    return r.select("run_id", "end_time", "test_accuracy_score")


def q_leaderboard(spark, sf):
    return registry.leaderboard(fx.runs(spark, sf), "val_f1_score", 10).select("run_id", "run_name", "val_f1_score")


def q_versions(spark, sf):
    return registry.versions(fx.version_events(spark, sf))


def q_current_stage(spark, sf):
    return registry.current_stage(fx.version_events(spark, sf))


def q_latest_versions(spark, sf):
    return registry.latest_versions(registry.current_stage(fx.version_events(spark, sf)))


def q_current_tags(spark, sf):
    return registry.current_tags(fx.version_events(spark, sf))


def _advanced(spark, sf, ev=None):
    """The state table after the event log has grown to a quarter, to three quarters, and whole."""
    name, ev = _table(spark, "state"), fx.version_events(spark, sf) if ev is None else ev
    top = ev.agg(F.max("seq")).first()[0] or 0
    for share in (0.25, 0.75, 1.0):
        state.advance(spark, ev.where(F.col("seq") <= int(top * share)), name)
    return tables.read_table(spark, name)


def q_current_stage_increment(spark, sf):
    return state.stage_view(_advanced(spark, sf))


def q_current_tags_increment(spark, sf):
    return state.tag_view(_advanced(spark, sf))


def q_model_tags(spark, sf):
    """Current tags of the models themselves, from the state kept up by increments."""
    return state.model_tag_view(_advanced(spark, sf, fx.model_events(spark, sf)))


def q_find_release(spark, sf):
    ev = fx.version_events(spark, sf)
    return registry.find_release(registry.current_stage(ev), registry.current_tags(ev))


def q_gate(spark, sf):
    ev = fx.version_events(spark, sf)
    return registry.gate(registry.current_tags(ev), registry.current_stage(ev), flow="validation")


# ------------------------------------------------------------ checks

def q_check_key(spark, sf):
    return checks.check_key(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_check_key_documents(spark, sf):
    return checks.check_key(fx.table(spark, sf, "documents"), "doc_id")


def q_check_schema(spark, sf):
    return checks.check_schema(fx.table(spark, sf, "customer"), CUSTOMER_CONTRACT)


def q_check_description(spark, sf):
    return fc.check_description(fx.table(spark, sf, "documents"), "text").select("doc_id", "has_description")


# ------------------------------------------------------------ sources / sinks

def q_append_predictions(spark, sf):
    s = fx.scored_rows(spark, sf)
    name = _table(spark, "preds")
    b1 = s.where(F.col("lang").isin("en", "de")).select("doc_id", "label", "prediction")
    b2 = s.where(~F.col("lang").isin("en", "de")).select("doc_id", "label", "prediction")
    tables.append_predictions(b1, name, batch_id="b1")
    tables.append_predictions(b2, name, batch_id="b2")
    tables.append_predictions(b2, name, batch_id="b2")  # a re-run replaces its batch
    return tables.read_table(spark, name).select("doc_id", "label", "prediction", "batch_id")


def q_csv_round_trip(spark, sf):
    c = fx.table(spark, sf, "customer")
    path = scratch_path(spark, "csv")
    files.write_csv(c, path)
    return files.read_csv_fixed(spark, path, c.schema)


def q_csv_inferred(spark, sf):
    """CSV read back with inferred types (small integers come back as int)."""
    c = fx.table(spark, sf, "customer")
    path = scratch_path(spark, "csv")
    files.write_csv(c, path)
    return files.read_csv_inferred(spark, path)


def q_external_table(spark, sf):
    """customer written to a path and registered as an external table."""
    name = _table(spark, "ext")
    tables.write_external_table(spark, fx.table(spark, sf, "customer"), name, scratch_path(spark, "ext"))
    return tables.read_table(spark, name)


def q_feature_table(spark, sf):
    name = _table(spark, "orders_features")
    feats, _ = jobs.compute_features(fx.attrition_rows(spark, sf), categorical=["o_orderpriority"],
                                     label="o_orderstatus", label_map={"F": 1, "O": 0})
    tables.write_feature_table(spark, feats, name, key="o_orderkey",
                               description="Orders with one-hot priority and a 0/1 label from the status.")
    return tables.read_table(spark, name)


# ------------------------------------------------------------ model pipeline

_TRAINED: dict = {}
LINE_KEY = ["l_orderkey", "l_linenumber"]


def _split_lineitem(spark, sf):
    rows = fx.training_rows(spark, sf)
    return split.hash_split(rows, LINE_KEY, 0.2, seed=0)


def _production_model(spark, sf) -> model.TrainedModel:
    k = (spark.sparkContext.applicationId, sf, "production")
    if k not in _TRAINED:
        marked = _split_lineitem(spark, sf)
        _TRAINED[k] = model.train_production(marked.where(F.col("split") == "train"), fx.TRAIN_FEATURES, "label")
    return _TRAINED[k]


def q_train_production(spark, sf):
    """Fit on the 80 % hash split; training and test metrics, one row each
    (counts, accuracy, and ROC / PR areas of the positive-class probability)."""
    m = _production_model(spark, sf)
    scored = model.score(m, _split_lineitem(spark, sf), keep=["split", "label"])
    return metrics.evaluate(scored, "label", by="split")


def q_booster_split(spark, sf):
    """The first split of a second-order tree on lineitem's quantity, discount
    and tax under the production settings (one tree of one split, all features)."""
    settings = {**model.PRODUCTION_PARAMS, "n_estimators": 1, "max_depth": 1, "num_leaves": 2, "colsample_bytree": 1.0}
    return _first_split(spark, boosting.train_booster(fx.training_rows(spark, sf), ["l_quantity", "l_discount", "l_tax"], "label", settings))


def _first_split(spark, booster):
    nodes = booster.nodes(spark)
    root, left, right = (nodes.where(F.col("node") == i) for i in range(3))
    side = lambda d, name: d.select(F.col("rows").alias(f"n_{name}"), F.round("value", 6).alias(f"{name}_value"))
    return root.select("feature", _r("threshold"), _r("gain", 3)).join(side(left, "left")).join(side(right, "right"))


def q_booster_leaves(spark, sf):
    """Per tree of the production model: the rows of its leaves, and whether
    the number of leaves and the rows of each obey the settings."""
    nodes = _production_model(spark, sf).model.nodes(spark)
    p = model.PRODUCTION_PARAMS
    return nodes.where("feature is null").groupBy("tree").agg(
        F.sum("rows").alias("n"), (F.count("*") <= p["num_leaves"]).cast("int").alias("few"),
        (F.min("rows") >= p["min_child_samples"]).cast("int").alias("filled"))


def q_score_function(spark, sf):
    """lineitem scored in SQL by the function of the production model: per
    label rows, and rows where it differs from the batch score."""
    m = _production_model(spark, sf)
    name = model.register_scoring(spark, m, "returns", "production")
    rows = m.transform(fx.training_rows(spark, sf))
    in_sql = F.expr(f"{name}({', '.join(fx.TRAIN_FEATURES)})")
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.count(F.when(~in_sql.eqNullSafe(F.col("probability")), 1)).alias("n_different"))


def q_score(spark, sf):
    m = _production_model(spark, sf)
    return model.score(m, fx.training_rows(spark, sf), keep=[*LINE_KEY, "label"])


def q_check_predicts(spark, sf):
    m = _production_model(spark, sf)
    return checks.check_predicts(model.score(m, fx.training_rows(spark, sf), keep=["label"]))


def _baseline_rows(spark, sf):
    """lineitem with the stratified 25 % validation split, written once: it is
    read by the preparation, the bins and the validation."""
    k = (spark.sparkContext.applicationId, sf, "baseline rows")
    if k not in _TRAINED:
        li = fx.table(spark, sf, "lineitem").select(*LINE_KEY, *fx.TRAIN_FEATURES, "l_linestatus",
                                                    (F.col("l_returnflag") == "R").cast("int").alias("label"))
        path = scratch_path(spark, "baseline-rows")
        split.stratified_split(li, "label", LINE_KEY, 0.25, seed=520692802).write.parquet(path)
        _TRAINED[k] = spark.read.parquet(path)
    return _TRAINED[k]


def _baseline_model(spark, sf) -> model.TrainedModel:
    k = (spark.sparkContext.applicationId, sf, "baseline")
    if k not in _TRAINED:
        _TRAINED[k] = model.train_baseline(_baseline_rows(spark, sf).where(F.col("split") == "train"), fx.TRAIN_FEATURES, "label",
                                           hashed=["l_linestatus"])
    return _TRAINED[k]


def q_train_baseline(spark, sf):
    """Stratified 25 % validation split, impute + hash + scale + boosted trees;
    one row of val_ metrics."""
    val = model.score(_baseline_model(spark, sf), _baseline_rows(spark, sf).where(F.col("split") == "test"), keep=["label"])
    return metrics.binary_metrics(val, "label", "prediction", "probability", prefix="val_")


def q_train_baseline_facts(spark, sf):
    """Rows and positives of the validation split as the metrics count them,
    trees, and leaves whose hessian sum is below the baseline's least."""
    nodes = _baseline_model(spark, sf).model.nodes(spark)
    light = (F.col("feature").isNull()) & (F.col("weight") < model.BASELINE_PARAMS["min_child_weight"])
    trees = nodes.agg(F.countDistinct("tree").alias("n_trees"), F.count(F.when(light, 1)).alias("n_light"))
    val = q_train_baseline(spark, sf)
    return val.select("val_n", (F.col("val_tp") + F.col("val_fn")).alias("val_positives")).join(F.broadcast(trees))  # a row each


def q_baseline_split(spark, sf):
    """The first split of the baseline's first tree on lineitem's quantity,
    discount and tax: min child weight, L2, a start at 0 (all rows, one split)."""
    settings = {**model.baseline_settings(), "n_estimators": 1, "max_depth": 1, "subsample": 1.0}
    return _first_split(spark, boosting.train_booster(fx.training_rows(spark, sf), ["l_quantity", "l_discount", "l_tax"], "label", settings))


def q_hash_text(spark, sf):
    p = fx.table(spark, sf, "part").select("p_partkey", "p_type")
    h = model.hash_text(p, "p_type")
    sparse = F.unwrap_udt("hashed")  # places and values of a row, not all 4096 slots
    place = F.get(sparse["indices"], (F.array_position(sparse["values"], 1.0) - 1).cast("int"))
    return h.select("p_partkey", "p_type", F.coalesce(place, F.lit(-1)).alias("hash_index"),
                    F.size(F.filter(sparse["values"], lambda x: x != 0)).alias("n_nonzero"))


def q_shapley(spark, sf):
    """Importance of the four features for one held-out row, against 100
    background rows of the training part, 20 feature orders."""
    m, example, train = _shapley_inputs(spark, sf, 1)
    return shapley(m, example, train, key="row_key", n_orders=20, max_background=100, seed=0)


def _shapley_inputs(spark, sf, n: int):
    """The production model, n held-out rows with a key that occurs once, and the training part."""
    marked = _split_lineitem(spark, sf).withColumn("row_key", F.concat_ws(":", *LINE_KEY))
    test = marked.where(F.col("split") == "test")
    once = test.groupBy("row_key").agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in fx.TRAIN_FEATURES]).where("_n = 1").drop("_n")
    return _production_model(spark, sf), split.sample_n(once, n, "row_key", seed=1), marked.where(F.col("split") == "train")


def q_score_stream(spark, sf):
    """Incremental scoring: the lineitem file arrives on a file stream, every
    row is scored once and appended under its epoch's batch id."""
    m = _production_model(spark, sf)
    src = f"{sf.rstrip('/')}/lineitem.parquet*"  # a glob: file sources watch directories
    schema = fx.table(spark, sf, "lineitem").schema
    name = _table(spark, "stream_preds")
    score_stream(spark, m, src, schema, name, keep=LINE_KEY)
    return tables.read_table(spark, name).select(*LINE_KEY, "prediction", "probability", "batch_id")


# What holds of the model queries whatever the trees are, so that SQL can check it.

def q_train_production_facts(spark, sf):
    """Rows and positives of each split, whether the confusion counts cover
    them, and whether the areas are shares."""
    t = q_train_production(spark, sf)
    positives = F.col("tp") + F.col("fn")
    return t.select("split", "n", positives.cast("bigint").alias("positives"),
                    (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn") == F.col("n")).cast("int").alias("covered"),
                    (F.col("roc_auc").between(0, 1) & F.col("pr_auc").between(0, 1)).cast("int").alias("areas"))


def q_score_facts(spark, sf):
    """Per label: rows, rows without a prediction, rows with a probability."""
    inside = F.col("probability").between(0, 1)
    return q_score(spark, sf).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("prediction").isNull(), 1)).alias("n_null"),
        F.count(F.when(inside, 1)).alias("n_probable"))


def q_score_stream_facts(spark, sf):
    """Every row of the stream is scored once."""
    return q_score_stream(spark, sf).groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.count("prediction").alias("n_scored"))


def q_hash_text_facts(spark, sf):
    """Per text: rows, and whether each has one slot, the same for all."""
    return q_hash_text(spark, sf).groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("n_nonzero").cast("int").alias("most"), F.min("n_nonzero").cast("int").alias("least"),
        (F.max("hash_index") - F.min("hash_index")).cast("int").alias("spread"))


def q_kernel_shapley(spark, sf):
    """Importance of the four features for five held-out rows by the Shapley
    kernel (all 14 coalitions, so the values are exact), against 100 background
    rows of the training part."""
    m, example, train = _shapley_inputs(spark, sf, 5)
    return kernel_shapley(m, example, train, key="row_key", max_background=100, seed=0, output="probability")


def _adds_up(spark, sf, values, n: int, output: str):
    """Per example: features with a value, and whether the values add up to
    the model's output less its mean over the background."""
    m, example, train = _shapley_inputs(spark, sf, n)
    mean = m.transform(split.sample_n(train, 100, "row_key", seed=0)).agg(F.avg(F.col(output)).alias("mean"))
    at = m.transform(example).select("row_key", F.col(output).cast("double").alias("at"))
    total = values.groupBy("row_key").agg(F.count("shap_value").alias("n_features"), F.sum("shap_value").alias("total"))
    out = total.join(at, "row_key").crossJoin(F.broadcast(mean))  # one row
    return out.select("row_key", "n_features", (F.abs(F.col("total") - (F.col("at") - F.col("mean"))) < 1e-6).cast("int").alias("adds_up"))


def q_shapley_facts(spark, sf):
    return _adds_up(spark, sf, q_shapley(spark, sf), 1, "prediction")


def q_kernel_shapley_facts(spark, sf):
    return _adds_up(spark, sf, q_kernel_shapley(spark, sf), 5, "probability")


QUERIES: dict[str, Query] = {
    "one_hot": q_one_hot,
    "label_map": q_label_map,
    "drop_nulls": q_drop_nulls,
    "build_features": q_build_features,
    "to_double": q_to_double,
    "impute_mean": q_impute_mean,
    "fill_constant": q_fill_constant,
    "impute_mode": q_impute_mode,
    "standardize": q_standardize,
    "drop_label_key": q_drop_label_key,
    "encode_categories": q_encode_categories,
    "impute_mean_merged": q_impute_mean_merged,
    "standardize_merged": q_standardize_merged,
    "impute_mode_merged": q_impute_mode_merged,
    "hash_split": q_hash_split,
    "stratified_split": q_stratified_split,
    "sample_n": q_sample_n,
    "smoke_rows": q_smoke_rows,
    "flag_correct": q_flag_correct,
    "accuracy": q_accuracy,
    "slice_accuracy": q_slice_accuracy,
    "slice_gate": q_slice_gate,
    "binary_metrics": q_binary_metrics,
    "roc_auc": q_roc_auc,
    "pr_auc": q_pr_auc,
    "log_loss": q_log_loss,
    "evaluate": q_evaluate,
    "hash_signed": q_hash_signed,
    "log_runs": q_log_runs,
    "select_run": q_select_run,
    "leaderboard": q_leaderboard,
    "versions": q_versions,
    "current_stage": q_current_stage,
    "latest_versions": q_latest_versions,
    "current_tags": q_current_tags,
    "current_stage_increment": q_current_stage_increment,
    "current_tags_increment": q_current_tags_increment,
    "model_tags": q_model_tags,
    "find_release": q_find_release,
    "gate": q_gate,
    "check_key": q_check_key,
    "check_key_documents": q_check_key_documents,
    "check_schema": q_check_schema,
    "check_description": q_check_description,
    "append_predictions": q_append_predictions,
    "csv_round_trip": q_csv_round_trip,
    "csv_inferred": q_csv_inferred,
    "external_table": q_external_table,
    "feature_table": q_feature_table,
    "train_production": q_train_production,
    "booster_split": q_booster_split,
    "booster_leaves": q_booster_leaves,
    "baseline_split": q_baseline_split,
    "score_function": q_score_function,
    "score": q_score,
    "check_predicts": q_check_predicts,
    "hash_text": q_hash_text,
    "shapley": q_shapley,
    "kernel_shapley": q_kernel_shapley,
    "score_stream": q_score_stream,
    "train_production_facts": q_train_production_facts,
    "score_facts": q_score_facts,
    "score_stream_facts": q_score_stream_facts,
    "hash_text_facts": q_hash_text_facts,
    "shapley_facts": q_shapley_facts,
    "kernel_shapley_facts": q_kernel_shapley_facts,
    # 100 trees of depth 8 (the baseline's settings): the slowest query, last
    "train_baseline": q_train_baseline,
    "train_baseline_facts": q_train_baseline_facts,
}
