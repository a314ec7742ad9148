"""Catalog tables: databases, managed and external tables, the feature
table, and idempotent appends of prediction batches.

The format is a parameter (default Parquet; Delta needs its jars)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.operators.checks import check_key
from tabflow.session import unique_name

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain table identifier: {name!r}")
    return name


def _literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if missing; ``location`` puts its managed tables
    under a chosen (shared) folder instead of the warehouse."""
    where = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(name)}{where}")


def reset_database(spark: SparkSession, name: str) -> None:
    """Drop the database with everything in it, then create it empty."""
    spark.sql(f"DROP DATABASE IF EXISTS {_ident(name)} CASCADE")
    spark.sql(f"CREATE DATABASE {_ident(name)}")


def list_databases(spark: SparkSession) -> list[str]:
    return [r[0] for r in spark.sql("SHOW DATABASES").collect()]


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(_ident(name))


def write_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Managed table write. A table cannot be overwritten while the same plan
    reads it; write to a new name and swap, or go through ``checkpoint``."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(_ident(name))


def write_external_table(spark: SparkSession, df: DataFrame, name: str, path: str, fmt: str = "parquet") -> None:
    """Overwrite files at ``path``, then (re)register an external table over them."""
    df.write.mode("overwrite").format(fmt).save(path)
    spark.sql(f"DROP TABLE IF EXISTS {_ident(name)}")
    spark.sql(f"CREATE TABLE {_ident(name)} USING {fmt} LOCATION {_literal(path)}")


def publish(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet", audit=None) -> None:
    """Write, audit, publish: df is evaluated once, into a staged table beside
    ``name``; ``audit(staged name)`` may raise, which leaves the old table as
    it was; else the staged table takes the name by renames in the catalog.
    df may read the table it replaces."""
    db, _, short = _ident(name).rpartition(".")
    at = f"{db}." if db else ""
    staged, old = f"{at}{unique_name(short + '_staged')}", f"{at}{unique_name(short + '_old')}"
    df.write.mode("errorifexists").format(fmt).saveAsTable(staged)
    try:
        if audit:
            audit(staged)
        there = spark.catalog.tableExists(name)
        if there:
            spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        except Exception:
            if there:
                spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    if there:
        spark.sql(f"DROP TABLE {old}")


def write_feature_table(spark: SparkSession, df: DataFrame, name: str, key: str | Sequence[str],
                        description: str = "", fmt: str = "parquet", check: bool = True) -> None:
    """Feature table: written to a staged table, whose primary key (unique,
    not null) is checked and which gets the description and key as metadata,
    then published under its name. A failed check leaves the old table."""
    keys = [key] if isinstance(key, str) else list(key)

    def audit(staged: str) -> None:
        bad = check_key(spark.table(staged), keys).limit(1).collect() if check else []
        if bad:
            raise ValueError(f"primary key {keys} is not unique / has nulls, e.g. {bad[0].asDict()}")
        spark.sql(f"ALTER TABLE {staged} SET TBLPROPERTIES ('primary_keys' = {_literal(','.join(keys))})")
        if description:
            spark.sql(f"COMMENT ON TABLE {staged} IS {_literal(description)}")

    publish(spark, df, name, fmt, audit)


def table_description(spark: SparkSession, name: str) -> str | None:
    return spark.catalog.getTable(_ident(name)).description


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_ident(name)}").collect()}


def set_properties(spark: SparkSession, name: str, values: Mapping[str, str]) -> None:
    pairs = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in values.items())
    spark.sql(f"ALTER TABLE {_ident(name)} SET TBLPROPERTIES ({pairs})")


def append_predictions(df: DataFrame, name: str, batch_id: str | None = None, fmt: str = "parquet") -> None:
    """Append a prediction batch. With ``batch_id`` the table is partitioned
    by ``batch_id`` and only that partition is overwritten, so re-running a batch
    replaces it instead of duplicating it, also with an empty one (partition
    pruning then serves reads of one batch)."""
    spark = df.sparkSession
    if batch_id is None:
        df.write.mode("append").format(fmt).saveAsTable(_ident(name))
        return
    out = df.withColumn("batch_id", F.lit(batch_id))
    if not spark.catalog.tableExists(name):
        out.write.mode("overwrite").format(fmt).partitionBy("batch_id").saveAsTable(_ident(name))
        return
    # a static partition: only this batch is overwritten, an empty one is cleared, and no session setting is touched
    view = unique_name("batch")
    df.select(*[c for c in spark.table(name).columns if c != "batch_id"]).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {_ident(name)} PARTITION (batch_id = {_literal(batch_id)}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
