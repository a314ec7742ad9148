"""Session and scratch-location helpers.

On a cluster the shared scratch folder is whatever ``spark.checkpoint.dir``
names; we only invent one (under the local temp dir) when it is unset, which
is the case in tests and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "*", app: str = "tabflow", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    # the in-memory catalog dies with the session; its warehouse must too
    warehouse = tempfile.mkdtemp(prefix="tabflow-warehouse-")
    for k, v in {**_LOCAL_CONF, "spark.sql.warehouse.dir": warehouse, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir); only if
    neither is set does it create a fresh local folder and register it, which
    other machines could not see: on a cluster it must be set.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tabflow-")
        sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the scratch root for one run."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    """A fresh table name (letters, digits, underscore) for one run."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    try:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    except (TypeError, ValueError):
        return int(os.cpu_count() or 8)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, by way of the shared folder, for
    clusters (and working directories) where it isn't installed."""
    import io
    import zipfile
    from pathlib import Path

    from pyarrow import fs as pafs

    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    top, data = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f"{top.name}/{f.relative_to(top)}")
    folder = scratch_path(spark, "package")
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{top.name}.zip") as out:
        out.write(data.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/{top.name}.zip")
