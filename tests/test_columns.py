import pytest
from pyspark.sql import functions as F

from tabflow.functions import columns as fc
from tabflow.operators.encode import OneHot
from tabflow.operators.scale import impute_mean, standardize


def test_to_double_blank_is_null(spark):
    df = spark.createDataFrame([("1", " "), ("2", "29.85"), ("3", None)], "k string, amount string")
    out = {r.k: r.amount for r in fc.to_double(df, "amount").collect()}
    assert out == {"1": None, "2": 29.85, "3": None}


def test_map_label_unmapped_is_null_and_renamed(spark):
    df = spark.createDataFrame([("a", "Yes"), ("b", "No"), ("c", "maybe"), ("d", None)], "k string, Churn string")
    out = fc.map_label(df, "Churn", out="churn")
    assert out.columns == ["k", "churn"]
    assert dict(out.select("k", "churn").collect()) == {"a": 1, "b": 0, "c": None, "d": None}
    assert dict(out.dtypes)["churn"] == "int"


def test_clean_names_rules_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], ["PaymentMethod_Bank transfer (automatic)", "x"])
    assert fc.clean_names(df).columns == ["PaymentMethod_Banktransfer-automatic", "x"]
    clash = spark.createDataFrame([(1, 2)], ["a b", "Ab"])
    with pytest.raises(ValueError):
        fc.clean_names(clash)


def test_one_hot_order_nulls_unseen(spark):
    df = spark.createDataFrame(
        [(1, "Mailed check", "x"), (2, "Bank transfer (automatic)", "y"), (3, None, "x")],
        "id int, PaymentMethod string, other string")
    enc = OneHot(["PaymentMethod"]).fit(df)
    assert enc.categories["PaymentMethod"] == ["Bank transfer (automatic)", "Mailed check"]
    out = fc.clean_names(enc.transform(df))
    assert out.columns == ["id", "other", "PaymentMethod_Banktransfer-automatic", "PaymentMethod_Mailedcheck"]
    rows = {r.id: (r[2], r[3]) for r in out.collect()}
    assert rows == {1: (0, 1), 2: (1, 0), 3: (0, 0)}
    unseen = spark.createDataFrame([(4, "Credit card", "z")], df.schema)
    assert tuple(enc.transform(unseen).first())[2:] == (0, 0)
    assert dict(out.dtypes)["PaymentMethod_Mailedcheck"] == "bigint"


def test_one_hot_row_sums_equal_non_null_count(spark):
    from tests.conftest import SF001
    from tabflow.plans import fixtures as fx
    o = fx.orders_with_nulls(spark, SF001)
    enc = OneHot(["o_orderstatus", "o_orderpriority"]).fit(o)
    nn = F.col("o_orderstatus").isNotNull().cast("int") + F.col("o_orderpriority").isNotNull().cast("int")
    out = enc.transform(o.withColumn("nn", nn))
    total = sum(F.col(f"`{c}`") for c in enc.output_names())
    assert out.where(total != F.col("nn")).count() == 0
    assert o.where(F.col("o_orderpriority").isNull()).count() > 0


def test_one_hot_cap(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("v"))
    with pytest.raises(ValueError):
        OneHot(["v"], max_values=10).fit(df)


def test_impute_mean_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (4, 3.0)], "k int, x double")
    out = dict(impute_mean(df, ["x"]).collect())
    assert out == {1: 1.0, 2: 2.0, 3: 2.0, 4: 3.0}


def test_standardize_population_and_zero_deviation(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 4.0, 5.0)], "k int, x double, c double")
    out = {r.k: (r.x, r.c) for r in standardize(df, ["x", "c"]).collect()}
    sd = (((1 - 7 / 3) ** 2 + (2 - 7 / 3) ** 2 + (4 - 7 / 3) ** 2) / 3) ** 0.5
    assert out[1][0] == pytest.approx((1 - 7 / 3) / sd)
    assert all(v[1] == 0.0 for v in out.values())


def test_description_rule(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 20), (4, "x" * 21)], "k int, d string")
    assert dict(fc.check_description(df, "d").select("k", "has_description").collect()) == {1: 0, 2: 0, 3: 0, 4: 1}


def test_flag_correct_null_is_zero(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, None, 1)], "k int, y int, p int")
    assert dict(fc.flag_correct(df, "y", "p").select("k", "accurate").collect()) == {1: 1, 2: 0, 3: 0}


def test_compute_features_null_order(spark):
    from tabflow.plans.jobs import compute_features
    raw = spark.createDataFrame(
        [("a", "Male", " ", "Yes"), ("b", "Female", "10.5", "No"), ("c", None, "3", "Yes"), ("d", "Male", "1", "maybe")],
        "customerID string, gender string, TotalCharges string, Churn string")
    lax, enc = compute_features(raw, ["gender"], "Churn")
    assert sorted(r.customerID for r in lax.collect()) == ["a", "b", "c"]  # blank amount kept as text
    assert lax.columns == ["customerID", "TotalCharges", "churn", "gender_Female", "gender_Male"]
    strict, _ = compute_features(raw, ["gender"], "Churn", strict=True, numeric_text=["TotalCharges"])
    assert sorted(r.customerID for r in strict.collect()) == ["b", "c"]
    assert dict(strict.dtypes)["TotalCharges"] == "double"


def test_feature_columns_numeric_only(spark):
    from datetime import datetime
    from tabflow.plans.jobs import feature_columns
    df = spark.createDataFrame([(1, "a", 2.0, True, datetime(2024, 1, 1), 1, "x")],
                               "id int, name string, x double, flag boolean, ts timestamp_ntz, churn int, note string")
    assert feature_columns(df, "churn", "id", ["name", "ts", "note"]) == ["x", "flag"]
    with pytest.raises(ValueError, match="note"):  # no column is dropped without a word
        feature_columns(df, "churn", "id", ["name", "ts"])
