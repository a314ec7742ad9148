"""Data-quality checks. Each returns a DataFrame of findings (empty = pass)
or a one-row verdict, computed by one aggregation over the whole table."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Offending primary-key values: repeated or containing a null, with
    their row count ``n``. A hash aggregate with map-side combine; a hot key
    collapses to one partial row per task before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    any_null = None
    for k in keys:
        any_null = F.col(k).isNull() if any_null is None else (any_null | F.col(k).isNull())
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) | any_null))


def schema_to_json(schema: T.StructType) -> str:
    return schema.json()


def schema_from_json(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def check_schema(df: DataFrame, contract: T.StructType | str) -> DataFrame:
    """Compare a table with a stored schema contract.

    One row per column of the contract or the table: ``column_name``,
    ``expected_type``, ``actual_type``, ``status`` ('ok', 'missing', 'extra',
    'wrong_type'), ``nulls`` — how many nulls the table holds in a contract
    column — and ``bad_values`` — how many non-null values do not convert to
    the contract's type (null for missing and extra columns). A column the
    contract marks non-nullable with nulls present gets status
    'null_violation'. All counts come from one aggregate over the table.
    """
    spec = schema_from_json(contract) if isinstance(contract, str) else contract
    actual = {f.name: f for f in df.schema.fields}
    expected = {f.name: f for f in spec.fields}
    present = [c for c in expected if c in actual]
    nulls, bad = {}, {}
    if present:
        aggs = []
        for c in present:
            col = F.col(f"`{c}`")
            aggs.append((F.count(F.lit(1)) - F.count(col)).alias(f"n_{c}"))
            aggs.append(F.count(F.when(col.isNotNull() & col.try_cast(expected[c].dataType).isNull(), 1))
                        .alias(f"b_{c}"))
        row = df.agg(*aggs).first()
        nulls = {c: int(row[f"n_{c}"]) for c in present}
        bad = {c: int(row[f"b_{c}"]) for c in present}
    rows = []
    for name, f in expected.items():
        a = actual.get(name)
        if a is None:
            rows.append((name, f.dataType.simpleString(), None, "missing", None, None))
            continue
        status = "ok"
        if a.dataType != f.dataType:
            status = "wrong_type"
        elif not f.nullable and nulls[name] > 0:
            status = "null_violation"
        rows.append((name, f.dataType.simpleString(), a.dataType.simpleString(), status, nulls[name], bad[name]))
    for name, a in actual.items():
        if name not in expected:
            rows.append((name, None, a.dataType.simpleString(), "extra", None, None))
    schema = ("column_name string, expected_type string, actual_type string, status string, "
              "nulls bigint, bad_values bigint")
    return df.sparkSession.createDataFrame(rows, schema)


def has_signature(contract: T.StructType | str | None) -> int:
    """1 when a model carries an input schema contract, else 0."""
    if contract is None:
        return 0
    spec = schema_from_json(contract) if isinstance(contract, str) else contract
    return 1 if len(spec.fields) > 0 else 0


def check_predicts(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """One row: ``predicts`` = 1 if every row got a non-null prediction, else 0.
    The scoring plan is forced by an aggregate, not collected."""
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.col(prediction)).alias("n_predicted"),
    ).select("n", "n_predicted",
             F.when((F.col("n") == F.col("n_predicted")), 1).otherwise(0).alias("predicts"))


def signature_faults(df: DataFrame, contract: T.StructType | str) -> list[tuple[str, str]]:
    """(column, fault) for every column of a model's signature that the table
    lacks ('missing') or holds in a type that can't stand for the signature's
    ('wrong_type'): numbers and booleans are good for numbers of any width,
    all other types only for themselves. Read from the schema; no job."""
    spec = schema_from_json(contract) if isinstance(contract, str) else contract
    actual = {f.name: f.dataType for f in df.schema.fields}
    number = (T.NumericType, T.BooleanType)
    out = []
    for f in spec.fields:
        if f.name not in actual:
            out.append((f.name, "missing"))
        elif isinstance(f.dataType, number):
            if not isinstance(actual[f.name], number):
                out.append((f.name, "wrong_type"))
        elif actual[f.name] != f.dataType:
            out.append((f.name, "wrong_type"))
    return out
