import pytest
from pyspark.sql import types as T

from tests.conftest import SF001
from tabflow.operators import checks
from tabflow.plans import fixtures as fx
from tabflow.session import scratch_path
from tabflow.sources import files, tables


def test_check_key_finds_repeats_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    got = {(r.k, r.n) for r in checks.check_key(df, "k").collect()}
    assert got == {(1, 2), (None, 1)}


def test_check_schema(spark):
    c = fx.table(spark, SF001, "customer")
    contract = T.StructType([T.StructField("c_custkey", T.LongType(), False),
                             T.StructField("c_nationkey", T.LongType()),
                             T.StructField("c_phone", T.StringType())])
    rows = {r.column_name: r.status for r in checks.check_schema(c, contract.json()).collect()}
    assert rows["c_custkey"] == "ok"
    assert rows["c_nationkey"] == "wrong_type"
    assert rows["c_phone"] == "missing"
    assert rows["c_mktsegment"] == "extra"
    nulls = spark.createDataFrame([(1,), (None,)], "c_custkey bigint")
    assert checks.check_schema(nulls, contract).where("column_name = 'c_custkey'").first().status == "null_violation"


def test_csv_fixed_and_inferred(spark, tmp_path):
    path = str(tmp_path / "raw.csv")
    with open(path, "w") as f:
        f.write("id,amount,label\n1,29.85,Yes\n2, ,No\n3,10,Yes\n")
    schema = "customerID string, totalCharges double, churnString string"
    fixed = files.read_csv_fixed(spark, path, schema)
    assert fixed.columns == ["customerID", "totalCharges", "churnString"]
    assert [r.totalCharges for r in fixed.orderBy("customerID").collect()] == [29.85, None, 10.0]
    inferred = files.read_csv_inferred(spark, path)
    assert dict(inferred.dtypes)["amount"] == "string"  # the blank keeps it text
    assert dict(inferred.dtypes)["id"] == "int"


def test_tables_feature_table_and_batches(spark):
    tables.reset_database(spark, "tabflow_test")
    assert "tabflow_test" in tables.list_databases(spark)
    df = spark.createDataFrame([(1, 0.5), (2, 0.7)], "k bigint, x double")
    tables.write_feature_table(spark, df, "tabflow_test.feats", "k", description="two rows, it's fine")
    props = tables.table_properties(spark, "tabflow_test.feats")
    assert props["primary_keys"] == "k"
    assert tables.table_description(spark, "tabflow_test.feats") == "two rows, it's fine"
    dup = spark.createDataFrame([(1, 0.5), (1, 0.7)], "k bigint, x double")
    with pytest.raises(ValueError):
        tables.write_feature_table(spark, dup, "tabflow_test.feats2", "k")
    tables.append_predictions(df, "tabflow_test.preds", batch_id="b1")
    tables.append_predictions(df, "tabflow_test.preds", batch_id="b2")
    tables.append_predictions(df, "tabflow_test.preds", batch_id="b2")
    got = tables.read_table(spark, "tabflow_test.preds").groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in got} == {"b1": 2, "b2": 2}
    ext = scratch_path(spark, "ext")
    tables.write_external_table(spark, df, "tabflow_test.ext", ext)
    assert tables.read_table(spark, "tabflow_test.ext").count() == 2
    tables.reset_database(spark, "tabflow_test")
    assert spark.catalog.listTables("tabflow_test") == []


def test_check_schema_counts_values_that_do_not_convert(spark):
    df = spark.createDataFrame([("1", "29.85"), ("2", " "), ("3", None)], "id string, TotalCharges string")
    contract = T.StructType([T.StructField("id", T.StringType()), T.StructField("TotalCharges", T.DoubleType())])
    row = checks.check_schema(df, contract).where("column_name = 'TotalCharges'").first()
    assert (row.status, row.nulls, row.bad_values) == ("wrong_type", 1, 1)
