import hashlib
import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tabflow.operators import checks, model, split
from tabflow.operators.shapley import coalitions, kernel_shapley, mode_values, shapley
from tabflow.plans import catalog
from tabflow.plans import fixtures as fx
from tabflow.session import scratch_path

KEY = ["l_orderkey", "l_linenumber"]


@pytest.fixture(scope="module")
def trained(spark):
    rows = fx.training_rows(spark, SF001)
    train, _ = split.train_test(rows, KEY, 0.2, seed=0)
    params = dict(model.PRODUCTION_PARAMS, n_estimators=3, min_child_samples=20)
    return model.train_production(train, fx.TRAIN_FEATURES, "label", params)


def test_score_keeps_every_row_and_checks(spark, trained):
    rows = fx.training_rows(spark, SF001)
    scored = model.score(trained, rows, keep=[*KEY, "label"])
    assert scored.count() == rows.count()
    p = checks.check_predicts(scored).first()
    assert p.predicts == 1 and p.n == rows.count()
    assert set(r.prediction for r in scored.select("prediction").distinct().collect()) <= {0, 1}
    with pytest.raises(ValueError):
        model.score(trained, rows.drop("l_tax"))


def test_score_tolerates_text_amounts_and_nulls(spark, trained):
    df = spark.createDataFrame([("1", "2.0", "100.0", "0.05", " "), ("2", None, "5.0", "0.0", "0.02")],
                               "id string, l_quantity string, l_extendedprice string, l_discount string, l_tax string")
    out = model.score(trained, df, keep=["id"]).collect()
    assert len(out) == 2 and all(r.prediction in (0, 1) for r in out)


def test_save_load_round_trip(spark, trained):
    path = scratch_path(spark, "model")
    model.save_model(trained, path)
    back = model.load_model(path)
    rows = fx.training_rows(spark, SF001)
    a = model.score(trained, rows, keep=KEY).orderBy(*KEY).collect()
    b = model.score(back, rows, keep=KEY).orderBy(*KEY).collect()
    assert a == b
    assert checks.has_signature(back.signature) == 1


def test_shapley_sums_to_prediction_gap(spark, trained):
    rows = fx.training_rows(spark, SF001).withColumn("row_key", F.concat_ws(":", *KEY))
    rows = rows.dropDuplicates(["row_key"])
    ex = split.sample_n(rows, 2, "row_key", seed=3)
    bg = split.sample_n(rows, 30, "row_key", seed=4)
    vals = shapley(trained, ex, rows, key="row_key", n_orders=6, max_background=30, seed=4, impute=False)
    got = {}
    for r in vals.collect():
        got.setdefault(r.row_key, 0.0)
        got[r.row_key] += r.shap_value
    fx_pred = {r.row_key: r.prediction for r in model.score(trained, ex, keep=["row_key"]).collect()}
    mean_bg = model.score(trained, bg, keep=["row_key"]).agg(F.avg("prediction")).first()[0]
    assert set(got) == set(fx_pred)
    for k, s in got.items():
        assert s == pytest.approx(fx_pred[k] - mean_bg, abs=1e-9)
    assert vals.count() == 2 * len(fx.TRAIN_FEATURES)


@pytest.mark.parametrize("output", ["prediction", "probability"])
def test_kernel_shapley_is_exact_with_all_coalitions(spark, trained, output):
    rows = fx.training_rows(spark, SF001).withColumn("row_key", F.concat_ws(":", *KEY)).dropDuplicates(["row_key"])
    ex, bg = split.sample_n(rows, 2, "row_key", seed=3), split.sample_n(rows, 12, "row_key", seed=4)
    got = {(r.row_key, r.feature): r.shap_value for r in kernel_shapley(trained, ex, rows, "row_key", max_background=12, seed=4, output=output).collect()}
    feats = fx.TRAIN_FEATURES
    x = [[float(r[c]) for c in feats] for r in ex.orderBy("row_key").collect()]
    b = np.array([[float(r[c]) for c in feats] for r in bg.collect()])

    def value(row, chosen):
        m = b.copy()
        m[:, list(chosen)] = np.array(row)[list(chosen)]
        margin = trained.model.margins(m)
        return np.mean(margin > 0) if output == "prediction" else np.mean(1 / (1 + np.exp(-margin)))

    for k, row in zip(sorted({k for k, _ in got}), x):
        for f, name in enumerate(feats):
            others = [i for i in range(4) if i != f]
            exact = sum(math.factorial(n) * math.factorial(3 - n) / 24 * (value(row, [*s, f]) - value(row, s)) for n in range(4) for s in itertools.combinations(others, n))
            assert got[k, name] == pytest.approx(exact, abs=1e-9)


def test_coalitions():
    z, w = coalitions(4, 100)
    assert len(z) == 14 and w.sum() == pytest.approx(1) and len({tuple(r) for r in z}) == 14
    assert w[0] == pytest.approx(3 / (1 * 3) / 4 / (1 + 3 / 4 + 1))  # a size's weight, shared by its coalitions
    z, w = coalitions(14, 300, seed=1)
    assert 0 < len(z) <= 302 and w.sum() == pytest.approx(1) and set(z.sum(1)) <= set(range(1, 14))
    assert {tuple(r) for r in z} == {tuple(1 - r) for r in z}
    assert len(coalitions(1, 10)[0]) == 0


def test_hash_signed_by_brute_force(spark):
    rows = [(1, "a", "b"), (2, None, "é"), (3, "x", "x"), (4, "", "a")]
    got = {r.i: [(p.slot, p.value) for p in r.hashed] for r in model.hash_signed(spark.createDataFrame(rows, "i int, p string, q string"), ["p", "q"], 8).collect()}
    for i, *texts in rows:
        slots = Counter()
        for t in texts:
            bits = int(hashlib.md5((t or "").encode()).hexdigest()[:8], 16)
            slots[bits % 2**31 % 8] += -1 if bits >= 2**31 else 1
        assert got[i] == sorted((k, float(v)) for k, v in slots.items() if v)


def test_scoring_function_by_stage(spark, trained):
    name = model.register_scoring(spark, trained, "churn", "Production")
    rows = fx.training_rows(spark, SF001)
    model.score(trained, rows, keep=fx.TRAIN_FEATURES).createOrReplaceTempView("lines_to_score")
    got = spark.sql(f"SELECT count(*) AS n, count_if({name}({', '.join(fx.TRAIN_FEATURES)}) = probability) AS same FROM lines_to_score").first()
    assert name == "churn_production" and got.n == got.same == rows.count()


def test_mode_values_ties_smallest(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (2.0, 6.0), (1.0, None)], "a double, b double")
    assert mode_values(df, ["a", "b"]) == {"a": 1.0, "b": 5.0}


def test_hash_text_one_slot(spark):
    p = fx.table(spark, SF001, "part").select("p_partkey", "p_type")
    h = model.hash_text(p, "p_type")
    n = h.select(F.size(F.filter(model.vector_to_array("hashed"), lambda x: x != 0)).alias("n")).distinct().collect()
    assert [r.n for r in n] == [1]


def test_fit_is_repeatable(spark):
    rows = fx.training_rows(spark, SF001)
    params = dict(model.PRODUCTION_PARAMS, n_estimators=2, min_child_samples=20)
    a = model.train_production(rows, fx.TRAIN_FEATURES, "label", params)
    b = model.train_production(rows, fx.TRAIN_FEATURES, "label", params)
    pa = model.score(a, rows, keep=KEY).orderBy(*KEY, "probability").collect()
    pb = model.score(b, rows, keep=KEY).orderBy(*KEY, "probability").collect()
    assert pa == pb


def test_baseline_prepares_its_features_and_obeys_the_child_weight(spark, tmp_path):
    rows = fx.table(spark, SF001, "lineitem").select(*KEY, *fx.TRAIN_FEATURES, "l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    rows = rows.withColumn("l_tax", F.when(F.col("l_linenumber") != 2, F.col("l_tax"))).withColumn("l_linestatus", F.when(F.col("l_linenumber") != 3, F.col("l_linestatus")))
    settings = {**model.BASELINE_PARAMS, "n_estimators": 3, "min_child_weight": 20, "subsample": 0.5}
    m = model.train_baseline(rows, fx.TRAIN_FEATURES, "label", hashed=["l_linestatus"], params=settings)
    nodes = m.model.nodes(spark).collect()
    assert len({r.tree for r in nodes}) == 3 and min(r.weight for r in nodes if r.feature is None) >= 20
    assert any((r.feature or "").startswith("slot") or r.feature in fx.TRAIN_FEATURES for r in nodes)
    assert m.model.base == 0 and all(r.rows < 0.6 * rows.count() for r in nodes)
    model.save_model(m, str(tmp_path / "baseline"))
    back = model.load_model(str(tmp_path / "baseline"))
    a, b = (model.score(x, rows, keep=KEY).orderBy(*KEY).collect() for x in (m, back))
    assert a == b and len(a) == rows.count() and all(0 < r.probability < 1 for r in a)
    with pytest.raises(ValueError):
        model.register_scoring(spark, m, "baseline", "production")


def test_hash_text_query_reads_the_sparse_row(spark, tmp_path):
    rows = [(1, "SMALL"), (2, None), (2, ""), (None, "SMALL"), (4, "ECONOMY")]
    spark.createDataFrame(rows, "p_partkey long, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    got = catalog.q_hash_text(spark, str(tmp_path))
    assert "UDF(hashed" not in got._jdf.queryExecution().executedPlan().toString()  # no array of all slots
    dense = model.hash_text(fx.table(spark, str(tmp_path), "part"), "p_type").select("p_partkey", "p_type", model.vector_to_array("hashed").alias("a")).collect()
    want = sorted(((r.p_partkey, r.p_type, r.a.index(1.0), sum(v != 0 for v in r.a)) for r in dense), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want and len(want) == 5
