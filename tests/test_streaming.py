from pyspark.sql import functions as F

from tests.conftest import SF001
from tabflow.operators import model
from tabflow.plans import fixtures as fx
from tabflow.session import scratch_path
from tabflow.streaming.scoring import score_stream

KEY = ["l_orderkey", "l_linenumber"]


def test_stream_scores_new_files_once(spark):
    rows = fx.training_rows(spark, SF001)
    params = dict(model.PRODUCTION_PARAMS, n_estimators=2, min_child_samples=20)
    m = model.train_production(rows, fx.TRAIN_FEATURES, "label", params)
    src = scratch_path(spark, "incoming")
    first = rows.where(F.col("l_orderkey") % 2 == 0)
    second = rows.where(F.col("l_orderkey") % 2 == 1)
    first.write.parquet(f"{src}/part=1")
    spark.sql("CREATE DATABASE IF NOT EXISTS tabflow_stream")
    ck = score_stream(spark, m, f"{src}/*", rows.schema, "tabflow_stream.preds", keep=[*KEY, "label"])
    assert spark.table("tabflow_stream.preds").count() == first.count()
    second.write.parquet(f"{src}/part=2")
    score_stream(spark, m, f"{src}/*", rows.schema, "tabflow_stream.preds", checkpoint=ck, keep=[*KEY, "label"])
    score_stream(spark, m, f"{src}/*", rows.schema, "tabflow_stream.preds", checkpoint=ck, keep=[*KEY, "label"])
    out = spark.table("tabflow_stream.preds")
    assert out.count() == rows.count()
    assert out.select("batch_id").distinct().count() == 2
