"""End to end: raw CSV -> bronze -> features -> train -> register ->
validate -> promote -> batch score -> retrain, twice without duplicates."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tabflow.operators import model, registry
from tabflow.plans import fixtures as fx
from tabflow.plans import jobs
from tabflow.session import scratch_path
from tabflow.sources import files, log, tables

SMALL = dict(model.PRODUCTION_PARAMS, n_estimators=3, min_child_samples=20)


@pytest.fixture(scope="module")
def ws(spark):
    tables.reset_database(spark, "tabflow_e2e")
    w = jobs.Workspace(spark, db="tabflow_e2e")
    raw = scratch_path(spark, "raw")
    orders = fx.attrition_rows(spark, SF001)
    files.write_csv(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"), raw)
    jobs.ingest_csv(spark, raw, "tabflow_e2e.bronze_orders",
                    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string")
    inferred = jobs.ingest_csv(spark, raw, "tabflow_e2e.bronze_inferred", location=scratch_path(spark, "bronze"))
    assert inferred.count() == orders.count()
    jobs.build_features(spark, spark.table("tabflow_e2e.bronze_orders"), "tabflow_e2e.features",
                        ["o_orderpriority"], "o_orderstatus", "o_orderkey", {"F": 1, "O": 0},
                        description="orders: one-hot priority, 0/1 label from status")
    return w


def test_flow(spark, ws):
    feats = spark.table("tabflow_e2e.features")
    assert "churn" in feats.columns and "o_orderpriority_4-NOTSPECIFIED" in feats.columns
    props = tables.table_properties(spark, "tabflow_e2e.features")
    assert props["primary_keys"] == "o_orderkey" and "categories" in props

    run_id = jobs.train(ws, "tabflow_e2e.features", "churn", "o_orderkey", "lgbm predict churn",
                        params=SMALL, demographic_vars="o_orderpriority_1-URGENT")
    info = jobs.run_info(ws, run_id)
    assert info["status"] == "FINISHED" and "test_accuracy_score" in info["metrics"]
    v = jobs.register(ws, run_id, "churn_model", "A model version description that is long enough.")
    assert v == 1
    res = jobs.validate(ws, "churn_model", stage="Staging")
    assert res["predicts"] == "1" and res["has_signature"] == "1" and res["has_description"] == "1"
    assert res["demo_test"] == "pass" and not res["rejected"]
    stage = {r.version: r.stage for r in registry.current_stage(ws.events()).collect()}
    assert stage[1] == "Staging"
    row = registry.latest_rows(registry.current_stage(ws.events()), registry.current_tags(ws.events()), ["staging"]).collect()
    assert [(r.version, r.run_id, r.description) for r in row] == [(1, run_id, "A model version description that is long enough.")]
    assert jobs.promote(ws, "churn_model") == 1
    assert {r.version: r.stage for r in registry.current_stage(ws.events()).collect()}[1] == "Production"
    out = jobs.score_batch(ws, "churn_model", "tabflow_e2e.preds", "2024-01")
    again = jobs.score_batch(ws, "churn_model", "tabflow_e2e.preds", "2024-01")
    assert out["rows"] == again["rows"] == feats.count()
    assert spark.table("tabflow_e2e.preds").count() == feats.count()  # re-run replaced its batch
    # an empty re-run clears its batch, and the session's overwrite mode is left alone
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    preds = spark.table("tabflow_e2e.preds").drop("batch_id")
    tables.append_predictions(spark.createDataFrame(preds.limit(3).collect(), preds.schema), "tabflow_e2e.preds", "it's 2")
    tables.append_predictions(spark.createDataFrame([], preds.schema), "tabflow_e2e.preds", "2024-01")
    assert {r.batch_id: r["count"] for r in spark.table("tabflow_e2e.preds").groupBy("batch_id").count().collect()} == {"it's 2": 3}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_text_amounts_travel_to_the_retrained_model(spark, ws):
    feats = spark.table("tabflow_e2e.features")
    amounts = feats.withColumn("amount", F.when(F.col("o_orderkey") % 50 == 0, "").otherwise((F.col("o_totalprice") * 2).cast("string")))
    tables.write_table(amounts.withColumn("note", F.lit("free text")), "tabflow_e2e.amounts")
    with pytest.raises(ValueError, match="amount"):
        jobs.train(ws, "tabflow_e2e.amounts", "churn", "o_orderkey", "r", params=SMALL)
    run_id = jobs.train(ws, "tabflow_e2e.amounts", "churn", "o_orderkey", "r", params=SMALL, numeric_text=["amount"], ignore=["note"])
    jobs.register(ws, run_id, "amount_model", "A model version description that is long enough.")
    res = jobs.retrain(ws, "tabflow_e2e.amounts", "amount_model", "churn", "o_orderkey", "r",
                       "Retrained model version with a long enough description.", params=SMALL)
    assert res["predicts"] == "1"
    tags = jobs.run_info(ws, res["run_id"])["tags"]
    m = model.load_model(tags["model_path"])
    assert "amount" in m.signature and "note" not in m.signature
    # the newest run above the floor is registered when no run id is given
    assert jobs.register_best(ws, "best_model", floor=2.0) is None
    assert jobs.register_best(ws, "best_model", floor=0.0) == 1


def test_a_rebuild_keeps_the_columns_of_absent_categories(spark, ws):
    rows = [(i, "xyz"[i % 3], float(i), "F" if i % 2 else "O") for i in range(60)]
    schema = "k long, c string, v double, y string"
    build = lambda r, **kw: jobs.build_features(spark, spark.createDataFrame(r, schema), "tabflow_e2e.months", ["c"], "y", "k", {"F": 1, "O": 0}, **kw)
    build(rows)
    before = spark.table("tabflow_e2e.months").columns
    build([r for r in rows if r[1] != "z"])
    assert spark.table("tabflow_e2e.months").columns == before
    build([r for r in rows if r[1] != "z"], refit=True)
    assert len(spark.table("tabflow_e2e.months").columns) == len(before) - 1


def test_retrain_twice(spark, ws):
    a = jobs.retrain(ws, "tabflow_e2e.features", "churn_model", "churn", "o_orderkey", "lgbm predict churn",
                     "Retrained model version with a long enough description.", params=SMALL)
    b = jobs.retrain(ws, "tabflow_e2e.features", "churn_model", "churn", "o_orderkey", "lgbm predict churn",
                     "Retrained model version with a long enough description.", params=SMALL)
    assert b["version"] == a["version"] + 1
    st = {r.version: r.stage for r in registry.current_stage(ws.events()).collect()}
    assert st[b["version"]] in ("Production", "None")
    runs = ws.runs().groupBy("run_id").count().where("count > 1").count()
    assert runs == 0


def test_validate_rejects_a_model_that_cannot_score(spark, ws):
    feats = spark.table("tabflow_e2e.features")
    tables.write_table(feats.drop("o_totalprice"), "tabflow_e2e.features_broken")
    good = ws.runs().where("status = 'FINISHED'").first()
    tags = dict(good.tags, db_table="tabflow_e2e.features_broken")
    registry.log_run(spark, ws.runs_table, run_id="broken", run_name="broken", metrics={}, tags=tags)
    v = jobs.register(ws, "broken", "broken_model", "A description that is long enough to pass.")
    res = jobs.validate(ws, "broken_model", v)
    assert res["predicts"] == "0" and res["has_signature"] == "0" and res["rejected"]
    st = {r.version: r.stage for r in registry.current_stage(ws.events().where("name = 'broken_model'")).collect()}
    assert st[v] == "Archived"


def test_versions_of_jobs_that_register_at_once_are_distinct(spark):
    tables.reset_database(spark, "tabflow_many")
    one, two = jobs.Workspace(spark, db="tabflow_many"), jobs.Workspace(spark, db="tabflow_many")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: jobs.register([one, two][i % 2], f"run{i}", "m", f"version of run {i}"), range(8)))
    assert sorted(got) == list(range(1, 9))
    ev = one.events()
    assert ev.count() == ev.select("seq").distinct().count() == 8 * 4
    tags = {(r.version, r.key): r.value for r in registry.current_tags(ev).collect()}
    assert all(tags[v, "run_id"] == f"run{i}" and tags[v, "description"] == f"version of run {i}" for i, v in enumerate(got))
    assert [r.version_number for r in registry.versions(ev).orderBy("version").collect()] == list(range(1, 9))
    jobs.describe_model(two, "m", "first")
    jobs.describe_model(one, "m", "second")
    assert [tuple(r) for r in registry.model_tags(one.events()).collect()] == [("m", "description", "second")]
    assert registry.current_tags(one.events()).count() == len(tags)


def test_an_append_that_lost_its_number_is_built_anew(spark):
    w = log.Log(spark, scratch_path(spark, "log"), registry.EVENT_SCHEMA)
    seen = []

    def build(events):
        seen.append(events.count())
        if len(seen) == 1:  # another writer comes between
            assert w.commit(lambda e: [registry.model_tag("m", "k", "other")])
        return [registry.model_tag("m", "k", "own")]

    w.commit(build)
    assert seen == [0, 1] and w.last() == 2 and [r.value for r in w.read().orderBy("seq").collect()] == ["other", "own"]
    assert w.commit(lambda e: []) == [] and w.last() == 2
    assert not log.write_new(spark, f"{w.path}/000000000002.json", "x")
