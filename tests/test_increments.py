"""State that is merged instead of recomputed, staged tables, dictionaries of any size."""

import pytest
from pyspark.sql import functions as F

from tabflow.operators import checks, encode, metrics, registry, scale, state
from tabflow.plans import fixtures as fx
from tabflow.session import unique_name
from tabflow.sources import tables
from tests.conftest import SF01


def test_state_reads_new_events_only(spark):
    ev = fx.version_events(spark, SF01)
    top = ev.agg(F.max("seq")).first()[0]
    name, seen = unique_name("state"), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    mark = None
    for share in (0.1, 0.5, 0.5, 1.0):
        part = ev.where(F.col("seq") <= int(top * share))
        if mark is not None:  # the counted rows are those above the mark
            new = part.where(F.col("seq") > mark).mapInArrow(count, ev.schema).count()
        mark = state.advance(spark, part, name)
        assert mark == part.agg(F.max("seq")).first()[0]
        st = spark.table(name)
        rows = lambda d, e: sorted(map(tuple, d.select(*e.columns).collect()), key=repr) == sorted(map(tuple, e.collect()), key=repr)
        assert rows(state.stage_view(st), registry.current_stage(part)) and rows(state.tag_view(st), registry.current_tags(part))
    assert seen.value < ev.count() and new > 0


def test_a_failed_audit_leaves_the_old_table(spark):
    name, seen = unique_name("features"), spark.sparkContext.accumulator(0)

    @F.udf("long")
    def once(x):
        seen.add(1)
        return x

    good = spark.range(50).select(once("id").alias("id"), F.lit("x").alias("v"))
    tables.write_feature_table(spark, good, name, "id", "fifty rows")
    assert seen.value == 50  # one evaluation of the source
    assert tables.table_description(spark, name) == "fifty rows" and tables.table_properties(spark, name)["primary_keys"] == "id"
    with pytest.raises(ValueError):
        tables.write_feature_table(spark, spark.range(9).select(F.lit(1).alias("id")), name, "id")
    assert spark.table(name).count() == 50
    assert not [t.name for t in spark.catalog.listTables() if "_staged" in t.name or t.name.startswith(f"{name}_old")]
    tables.publish(spark, spark.table(name).where("id < 7"), name)  # reads what it replaces
    assert spark.table(name).count() == 7


def test_moments_and_modes_merge_to_a_full_fit(spark):
    rows = [("a", 1.0, 5.0), ("a", None, 5.0), ("b", 4.0, 6.0), ("c", float("nan"), 6.0), (None, 9.5, None), ("d", None, None)]
    df = spark.createDataFrame(rows, "month string, x double, y double")
    state_rows = scale.moment_state(df, ["x", "y"], "month")
    got = scale.merge_moments(state_rows)
    clean = df.withColumn("x", F.nanvl("x", F.lit(None)))
    for c, (mean, sd) in scale.fit_scaling(clean, ["x", "y"]).items():
        assert got[c] == pytest.approx((mean, sd))
    assert scale.merge_modes(scale.mode_state(clean, ["x", "y"], "month")) == {"x": 1.0, "y": 5.0}
    assert scale.merge_moments(state_rows.where("false")) == {}


def test_dictionary_of_many_values(spark):
    df = spark.range(300_000).select("id", F.concat(F.lit("c"), "id").alias("a"), F.when(F.col("id") % 3 != 0, F.lit("hot")).alias("b"))
    d = encode.category_table(df, ["a", "b"])
    coded = encode.encode_sparse(df, d, ["a", "b"])
    facts = coded.agg(F.count("*"), F.countDistinct(F.get("indices", F.lit(0))), F.min(F.get("indices", F.lit(0))), F.max(F.get("indices", F.lit(0))),
                      F.sum(F.size("indices")), F.max("n_features"), F.max(F.get("indices", F.lit(1)))).first()
    assert tuple(facts) == (300_000, 300_000, 0, 299_999, 500_000, 300_001, 300_000)
    unseen = encode.encode_sparse(spark.createDataFrame([(1, "new", None)], "id int, a string, b string"), d, ["a", "b"]).first()
    assert unseen["indices"] == [] and unseen["n_features"] == 300_001


def test_evaluate_equals_the_single_metrics(spark):
    rows = [(s, i % 3 == 0, float(i % 2), None if i % 11 == 0 else (i * 37 % 50) / 50) for i in range(200) for s in ("u", None)[: 1 + i % 2]]
    df = spark.createDataFrame([(s, int(y), p, q) for s, y, p, q in rows], "split string, label int, prediction double, probability double")
    for r in metrics.evaluate(df, "label").collect():
        own = df.where(F.col("split").eqNullSafe(F.lit(r["split"])))
        one, area = metrics.binary_metrics(own, "label", "prediction", "probability").first(), metrics.roc_pr_auc(own, "label", "probability").first()
        for k, v in one.asDict().items():
            if k != "log_loss":
                assert r[k] == pytest.approx(v), k
        loss = metrics.binary_metrics(own.where("probability is not null"), "label", "prediction", "probability").first()["log_loss"]
        assert (r["log_loss"], r["roc_auc"], r["pr_auc"]) == pytest.approx((loss, area["roc_auc"], area["pr_auc"]))
    assert metrics.evaluate(df.where("false"), "label").collect() == []


def test_signature_faults(spark):
    df = spark.createDataFrame([(1, "x", True, "t")], "a int, b string, c boolean, d string")
    spec = "a double, b double, c double, d string, e double"
    assert checks.signature_faults(df, spark.createDataFrame([], spec).schema) == [("b", "wrong_type"), ("e", "missing")]
