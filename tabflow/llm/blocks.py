"""Blocks of integer vectors: rows of a table that hold some thousand vectors each, for work in numpy.

A block has the vectors' other columns as lists and the vectors as one matrix of 32-bit integers. Distances between vectors
are exact in 64-bit integers as long as no scaled component is beyond the limit; a table that holds one is refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import materialise_at

#: Vectors of a block.
BLOCK = 4096


def finite(v: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & good, F.lit(False))


def integers(v: list | np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component; scale is a power of two, so that no rounding happens."""
    return np.floor(np.asarray(v, np.float64) * scale).astype(np.int64)


def limit(size: int) -> int:
    """The largest component for which squared distances of vectors of this size fit 64 bits."""
    return int(min(2**30, (2**62 / max(1, size)) ** 0.5 / 2))


def cut(spark: SparkSession, kept: DataFrame, others: str, size: int, scale: int, name: str, extra: str = "", finish=None) -> tuple[DataFrame, str]:
    """The blocks of kept (columns of others, v), written: others as lists, x (integers of 4 bytes, row by row) and what
    finish(x) adds in the columns of extra."""
    bound = limit(size)
    top = kept.agg(F.max(F.greatest(F.abs(F.array_max("v").cast("double")), F.abs(F.array_min("v").cast("double"))))).first()[0]
    if top is not None and top * scale > bound - 1:
        raise ValueError(f"a component of {top} times {scale} is beyond {bound}: squared distances would not fit 64 bits")
    fields = [x.split() for x in others.split(", ")]
    names = [c for c, _ in fields]

    def pack(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
                x = integers(flat, scale).reshape(batch.num_rows, size)
                row = {c: pa.array([batch.column(c).to_pylist()], pa.list_(batch.column(c).type)) for c in names}
                row["x"] = pa.array([x.astype(np.int32).tobytes()], pa.binary())
                for c, value in (finish(x) if finish else {}).items():
                    row[c] = pa.array([value])
                yield pa.RecordBatch.from_pydict(row)

    schema = ", ".join(f"{c} array<{t}>" for c, t in fields) + ", x binary" + extra
    return materialise_at(spark, kept.select(*names, "v").mapInArrow(pack, schema), name)


def matrix(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, np.int32).reshape(-1, size).astype(np.int64)


def means(parts: DataFrame, shape: tuple[int, ...], before: np.ndarray) -> np.ndarray:
    """floor(sum / count) of each group's components; a group without rows keeps its values. parts has partial sums
    (at, s, n): the component's place in the flattened shape, the sum and the number of vectors of its group. As many rows
    as there are components reach the driver."""
    out = before.reshape(-1).copy()
    for r in parts.groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect():
        out[r["at"]] = int(r["s"]) // int(r["n"])
    return out.reshape(shape)


def partial(sums: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Rows (at, s, n) of a task's sums (groups x components) and counts (groups)."""
    size = sums.shape[-1]
    some = np.flatnonzero(np.repeat(counts.reshape(-1) > 0, size))
    columns = [pa.array(some, pa.int64()), pa.array(sums.reshape(-1)[some], pa.int64()), pa.array(np.repeat(counts.reshape(-1), size)[some], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["at", "s", "n"])


PARTIAL = "at long, s long, n long"
