"""Small helpers shared by the corpus operators: scratch tables, file systems, byte-bounded batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from tabflow.session import scratch_path, ship  # noqa: F401

#: Bytes of text that one Python call works on at a time; bounds a worker's memory whatever the batch it is handed.
SLICE_BYTES = 4 << 20


#: Scratch tables that were written and not dropped.
made: list[str] = []


def materialise(spark: SparkSession, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write df as Parquet into the shared scratch folder and read it back.

    This cuts the lineage: later stages and retries after a lost executor read committed files, so values that depend on
    a task (its number, its order of rows) are computed once.
    """
    return materialise_at(spark, df, name, compression)[0]


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's URI and the folder's path in it; works on the driver and on executors alike."""
    return pafs.FileSystem.from_uri(uri)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the named string column holds about ``limit`` bytes in each (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        group = np.cumsum(sizes) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(a, b - a)


def give_back() -> None:
    """Return the memory that this process has freed to the system. Arrow's pool and the C library keep it else, for as long
    as the worker waits for its next task, while the JVM beside it may need the executor's memory for itself."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def frugal(work: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A function of an iterator of batches that gives back its memory at the end of the task."""
    @wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def materialise_at(spark: SparkSession, df: DataFrame, name: str, compression: str = "zstd") -> tuple[DataFrame, str]:
    """Like materialise, with the folder's path for drop_table."""
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    made.append(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    fs, root = file_system(path)
    fs.delete_dir(root)
    if path in made:
        made.remove(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage: Spark deletes the shuffle files of finished jobs only then."""
    spark.sparkContext._jvm.System.gc()
