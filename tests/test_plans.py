"""Plan properties that matter at scale, read from explain('formatted')."""

import io
import re
from contextlib import redirect_stdout

import pytest

from tests.conftest import SF01
from tabflow.plans import catalog


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _window_partitions(plan: str) -> list[str]:
    """The partition clause of every Window node, empty if it has none."""
    out = []
    for block in plan.split("\n\n"):
        if re.match(r"^\(\d+\) Window\b", block.strip()):
            m = re.search(r"Arguments: \[.*?windowspecdefinition\((.*?)\b(?:ASC|DESC)\b.*?\](?:, \[(.*?)\])?(?:, \[.*?\])?$", block, re.S | re.M)
            lists = re.findall(r"\[([^\[\]]*)\]", block.split("Arguments:")[1])
            specs = [x for x in lists if "windowspec" not in x and not re.search(r"\b(ASC|DESC)\b", x)]
            out.append(specs[0] if m and specs else "")
    return out


#: Queries whose one window without a partition clause runs over a bounded table.
BOUNDED = {"roc_auc": "bucket", "pr_auc": "bucket"}


@pytest.mark.parametrize("name", ["roc_auc", "pr_auc", "versions", "stratified_split", "shapley"])
def test_no_window_over_a_single_partition(spark, name):
    parts = _window_partitions(_plan(catalog.QUERIES[name](spark, SF01)))
    assert parts, "expected windows in this plan"
    assert sum(not p.strip() for p in parts) <= (name in BOUNDED), parts


def test_the_window_check_notices_a_single_partition(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(10).withColumn("g", F.col("id") % 3)
    bad = df.withColumn("r", F.row_number().over(Window.orderBy("id")))
    good = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    assert [bool(p.strip()) for p in _window_partitions(_plan(bad))] == [False]
    assert [bool(p.strip()) for p in _window_partitions(_plan(good))] == [True]


@pytest.mark.parametrize("name, columns", [
    ("check_key", {"l_orderkey", "l_linenumber"}),
    ("standardize", {"c_custkey", "c_acctbal"}),
    ("label_map", {"o_orderkey", "o_orderstatus"}),
])
def test_scans_read_only_used_columns(spark, name, columns):
    plan = _plan(catalog.QUERIES[name](spark, SF01))
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert schemas
    for s in schemas:
        assert {c.split(":")[0] for c in s.split(",")} == columns


def test_filters_reach_the_scan(spark):
    from pyspark.sql import functions as F
    from tabflow.plans import fixtures as fx
    df = fx.scored_rows(spark, SF01).where(F.col("lang") == "en")
    plan = _plan(df)
    assert "EqualTo(lang,en)" in plan


def test_feature_build_is_one_codegen_stage(spark):
    plan = _plan(catalog.QUERIES["build_features"](spark, SF01))
    assert "Exchange" not in plan and "* Project" in plan


def test_scored_join_never_reads_document_text(spark):
    from tabflow.plans import fixtures as fx
    plan = _plan(fx.scored_rows(spark, SF01))
    schemas = [set(c.split(":")[0] for c in s.split(",")) for s in re.findall(r"ReadSchema: struct<(.*)>", plan)]
    assert {"doc_id", "lang", "n_chars"} in schemas
    assert {"doc_id", "quality", "toxic"} in schemas
    assert all("text" not in s for s in schemas)
