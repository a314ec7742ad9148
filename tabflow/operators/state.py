"""Views of the version-event log kept up by increments.

The current stages and tags of ``registry`` are aggregates over the whole
log. Their partial aggregates can be merged: a state table holds, per model
and version, when it was registered, its last own stage and its last tags,
and per model and stage the last change that archives others. ``advance``
aggregates only the events above the state's high-water mark, merges them
into it and publishes the new table; the views read the state alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.sources import tables

_KEYS = ["kind", "name", "version", "key"]


def event_state(events: DataFrame) -> DataFrame:
    """The state of a set of events: (kind, name, version, key, value, seq,
    first, last) with kind 'registered', 'stage', 'tag' or 'archive'."""
    def part(rows: DataFrame, kind: str, version, key, value) -> DataFrame:
        none = F.lit(None).cast("string")
        return rows.select(F.lit(kind).alias("kind"), "name", version.cast("long").alias("version"), (none if key is None else F.col(key)).alias("key"),
                           (none if value is None else F.col(value)).alias("value"), "seq", F.col("seq").alias("first"), F.col("seq").alias("last"))

    version, stages = F.col("version"), events.where(F.col("kind") == "stage")
    parts = [part(events.where(version.isNotNull()), "registered", version, None, None), part(stages, "stage", version, None, "to_stage"),
             part(events.where(F.col("kind") == "tag"), "tag", version, "key", "value"),
             part(stages.where(F.col("archive_existing")), "archive", F.lit(None), "to_stage", None)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return merge(every)


def merge(states: DataFrame) -> DataFrame:
    """One state of the rows of several, given as their union."""
    return states.groupBy(*_KEYS).agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq"),
                                      F.min("first").alias("first"), F.max("last").alias("last"))


def high_water(state: DataFrame) -> int | None:
    return state.agg(F.max("last")).first()[0]


def advance(spark: SparkSession, events: DataFrame, table: str) -> int | None:
    """Bring the state table up to the log; returns its high-water mark (the
    log's sequence numbers must grow). Without new events nothing is written."""
    old = spark.table(table) if spark.catalog.tableExists(table) else None
    mark = high_water(old) if old is not None else None
    new = event_state(events if mark is None else events.where(F.col("seq") > mark))
    if old is not None and new.isEmpty():
        return mark
    tables.publish(spark, merge(new if old is None else old.unionByName(new)), table)
    return high_water(spark.table(table))


def stage_view(state: DataFrame) -> DataFrame:
    """As ``registry.current_stage``."""
    of = lambda kind: state.where(F.col("kind") == kind)
    own = of("stage").select("name", "version", F.col("value").alias("own_stage"), F.col("seq").alias("stage_seq"))
    archive = of("archive").select("name", F.col("key").alias("own_stage"), F.col("seq").alias("archive_seq"))
    out = of("registered").select("name", "version", "first").join(own, ["name", "version"], "left").join(archive, ["name", "own_stage"], "left")
    stage = (F.when(F.col("own_stage").isNull(), F.lit("None")).when(F.col("archive_seq") > F.col("stage_seq"), F.lit("Archived")).otherwise(F.col("own_stage")))
    return out.select("name", "version", stage.alias("stage"), F.coalesce("stage_seq", "first").alias("stage_seq"))


def tag_view(state: DataFrame) -> DataFrame:
    """As ``registry.current_tags``."""
    return state.where((F.col("kind") == "tag") & F.col("version").isNotNull()).select("name", "version", "key", "value")


def model_tag_view(state: DataFrame) -> DataFrame:
    """As ``registry.model_tags``."""
    return state.where((F.col("kind") == "tag") & F.col("version").isNull()).select("name", "key", "value")
