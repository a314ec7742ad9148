"""Incremental batch inference with Structured Streaming.

The monthly scoring job re-expressed as a file stream: only feature files
that arrived since the last run are scored. Each micro-batch is written with
``append_predictions`` under batch id ``{prefix}{epoch}`` (dynamic partition
overwrite), and the source offsets live in the checkpoint, so a job that dies
mid-batch and is restarted replays that epoch over its own partition:
exactly-once rows in the predictions table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabflow.operators.model import TrainedModel, score
from tabflow.session import scratch_path
from tabflow.sources.tables import append_predictions


def score_stream(
    spark: SparkSession,
    model: TrainedModel,
    source: str,
    schema: T.StructType | str,
    predictions_table: str,
    checkpoint: str | None = None,
    keep: Sequence[str] | None = None,
    batch_prefix: str = "epoch-",
    max_files_per_trigger: int | None = None,
) -> str:
    """Score every not-yet-seen Parquet file under ``source`` and stop
    (``availableNow`` trigger). Returns the checkpoint location; pass it again
    on the next run to continue from where this one ended."""
    checkpoint = checkpoint or scratch_path(spark, "score-stream")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(source)
    scored = score(model, stream, keep=keep)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        append_predictions(batch, predictions_table, batch_id=f"{batch_prefix}{epoch_id}")

    q = (scored.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return checkpoint
