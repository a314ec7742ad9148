"""A log that several writers append to at once: a folder of numbered JSON files.

An append is one file, and its number is the order of the log. A writer builds
its rows from the log up to the last number, writes them to a file of a name of
its own, and gives that file the next number, which fails if another writer has
taken it: then the rows are built anew from the longer log. So rows that depend
on the log (the next version of a model) are right whoever else writes, numbers
have no gaps, what is read never changes, and the file of a writer that was lost
has no number and is not read. Needs a file system that refuses to rename onto
an existing file (HDFS and local folders do). Appends are meant to be small and
rare, such as registry events: each is a file that later reads list.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that one append may have; a row's sequence number is its file's times this, plus its place.
ROWS = 1 << 20


def _local(path: str) -> str | None:
    parts = urlparse(path)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def create_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file of this name, whole or not at all; False if there is one already."""
    folder, name = path.rsplit("/", 1)
    own = f"{folder}/.{name}-{uuid.uuid4().hex}"
    if (target := _local(path)) is not None:
        with open(_local(own), "x", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(_local(own), target)
        except FileExistsError:
            return False
        finally:
            os.unlink(_local(own))
        return True
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    source, target = hadoop.Path(own), hadoop.Path(path)
    files = source.getFileSystem(conf)
    out = files.create(source, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    kind = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(source, target, options)
    except Py4JJavaError as e:
        files.delete(source, False)
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


class Log:
    """The log in a folder, with rows of a schema whose first column, a long, is the sequence number."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        create_folder(spark, self.path)

    def _rows(self) -> DataFrame:
        place = T.StructType([T.StructField("place", T.LongType()), *self.schema.fields[1:]])
        return self.spark.read.schema(place).json(self.path).withColumn("number", F.substring(F.col("_metadata.file_name"), 1, 12).cast("long"))

    def last(self) -> int:
        """The number of the last append, 0 if there is none."""
        return self._rows().agg(F.max("number")).first()[0] or 0

    def read(self, upto: int | None = None) -> DataFrame:
        rows = self._rows()
        if upto is not None:
            rows = rows.where(F.col("number") <= upto)
        seq = (F.col("number") * ROWS + F.col("place")).alias(self.schema.fields[0].name)
        return rows.select(seq, *[F.col(f"`{f.name}`") for f in self.schema.fields[1:]])

    def commit(self, build: Callable[[DataFrame], Sequence[tuple]]) -> list[tuple]:
        """Append the rows (without sequence numbers) that ``build`` makes of the log as it is, again if another append
        came between; returns them. No rows are no append."""
        names = [f.name for f in self.schema.fields[1:]]
        while True:
            last = self.last()
            rows = list(build(self.read(last)))
            if not rows:
                return rows
            if len(rows) > ROWS:
                raise ValueError(f"{len(rows)} rows in one append; at most {ROWS}")
            lines = [json.dumps({"place": i, **dict(zip(names, row, strict=True))}) for i, row in enumerate(rows)]
            if write_new(self.spark, f"{self.path}/{last + 1:012d}.json", "\n".join(lines)):
                return rows
