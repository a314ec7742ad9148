"""Token-ID output: length-delimited binary records with masked checksums and a separate offset index.

File format. Each record is framed as

    uint64 length | uint32 masked_crc32c(length) | data | uint32 masked_crc32c(data)

all little-endian, with masked(c) = ((c >> 15 | c << 17) + 0xa282ead8) mod 2^32, which is the framing that TFRecord
readers know. The data is one sequence: int64 doc_id, uint8 flags (bit 0: doc_id is null), uint8 bytes per id (2 or 4),
uint16 zero, then the ids. The index, a Parquet table beside the files, has a row per record with the file, the byte
offset and the length of its data, so that shuffled reads can seek.

Edge cases: null text counts as empty (its record holds the end id alone); null doc_ids come first; repeated doc_ids each
get a record, in the order of their texts; an empty table gives no file and an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.llm.common import file_system, materialise, slices
from tabflow.llm.tokens import encoder
from tabflow.session import scratch_path, shuffle_partitions

INDEX_SCHEMA = "part int, nth long, doc_id long, file string, data_offset long, data_length long, n_tokens long"
READ_SCHEMA = "part int, nth long, doc_id long, part_start long, n_tokens long, ids_crc32 long"
_HEAD, _DATA = struct.Struct("<QI"), struct.Struct("<qBBH")
_POLY = 0x82F63B78  # fixed value: CRC-32C, reflected
_MASK = 0xA282EAD8  # fixed value of the framing
_LANE = 256
FRAME_BYTES = _HEAD.size + 4


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The byte table of CRC-32C, and what _LANE zero bytes make of each byte of the register."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(_POLY), byte >> 1)
    shift = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    for _ in range(_LANE):
        shift = byte[shift & 0xFF] ^ (shift >> 8)
    return byte, shift


_BYTE, _SHIFT = _tables()


def masked_crc32c(buffers: list[bytes]) -> np.ndarray:
    """Masked CRC-32C of each buffer of at least 4 bytes, all buffers at once.

    Zero bytes before a message leave a zero register alone, so every buffer is padded in front to whole lanes; lanes run
    in parallel and are then folded from left to right. Inverting the first 4 bytes stands for the initial register.
    """
    n = np.array([-(-len(b) // _LANE) for b in buffers], dtype=np.int64)
    data = np.frombuffer(b"".join(bytes(k * _LANE - len(b)) + bytes(x ^ 0xFF for x in b[:4]) + b[4:] for k, b in zip(n.tolist(), buffers)), np.uint8)
    lanes = np.ascontiguousarray(data.reshape(-1, _LANE).T)
    reg = np.zeros(lanes.shape[1], np.uint32)
    for row in lanes:
        reg = _BYTE[(reg ^ row) & 0xFF] ^ (reg >> 8)
    last = np.cumsum(n)
    out, order = np.zeros(len(buffers), np.uint32), np.argsort(-n, kind="stable")
    for step in range(int(n.max(initial=0)), 0, -1):  # the lane that is step-th from the end, of buffers that have it
        own = order[: np.searchsorted(-n[order], -step, side="right")]
        r = out[own]
        out[own] = _SHIFT[0][r & 0xFF] ^ _SHIFT[1][r >> 8 & 0xFF] ^ _SHIFT[2][r >> 16 & 0xFF] ^ _SHIFT[3][r >> 24] ^ reg[last[own] - step]
    out = ~out
    return ((out >> 15) | (out << 17)) + np.uint32(_MASK)


_BYTE_LIST = _BYTE.tolist()


def _masked_small(data: bytes) -> int:
    """Masked CRC-32C of one short buffer."""
    reg = 0xFFFFFFFF
    for x in data:
        reg = _BYTE_LIST[(reg ^ x) & 0xFF] ^ (reg >> 8)
    reg ^= 0xFFFFFFFF
    return ((reg >> 15 | reg << 17) + _MASK) & 0xFFFFFFFF


def frame(datas: list[bytes]) -> list[bytes]:
    sizes = [struct.pack("<Q", len(d)) for d in datas]
    return [s + struct.pack("<I", _masked_small(s)) + d + struct.pack("<I", b) for s, d, b in zip(sizes, datas, masked_crc32c(datas).tolist())]


def read_frames(stream) -> Iterator[list[bytes]]:
    """The records' data in order, in bounded groups; raises ValueError on a wrong checksum or a cut file."""
    group, sums, held = [], [], 0

    def verified() -> list[bytes]:
        if masked_crc32c(group).tolist() != sums:
            raise ValueError("a record's checksum is wrong")
        return group

    while head := stream.read(_HEAD.size):
        if len(head) < _HEAD.size:
            raise ValueError("the file ends within a record")
        length, check = _HEAD.unpack(head)
        if _masked_small(head[:8]) != check:
            raise ValueError("a length's checksum is wrong")
        data, tail = stream.read(length), stream.read(4)
        if len(data) < length or len(tail) < 4:
            raise ValueError("the file ends within a record")
        group.append(data)
        sums.append(struct.unpack("<I", tail)[0])
        held += length
        if held > 4 << 20:
            yield verified()
            group, sums, held = [], [], 0
    if group:
        yield verified()


def write_records(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 0, out: str | None = None) -> DataFrame:
    """Encode docs (doc_id, text), append end_id and write record files in ascending doc_id order; returns the index.

    Rows are dealt by ranges of (doc_id, first 64 characters of the text) and sorted by (doc_id, text) within them; file k
    holds range k, and the texts of one doc_id may fill several files. A task writes to a file of a name of
    its own and hands on index rows; Spark commits those, so a file of an attempt that was lost is in no index.
    """
    folder = out or scratch_path(spark, "records")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    first = F.col("doc_id").asc_nulls_first()
    rows = rows.repartitionByRange(shuffle_partitions(spark), first, F.substring("text", 1, 64)).sortWithinPartitions(first, "text")

    def write(batches):
        enc = encoder(tokenizer)
        width = 2 if max(enc.size - 1, end_id) < 1 << 16 else 4
        part, nth, at, stream = TaskContext.get().partitionId(), 0, 0, None
        fs, root = file_system(folder)
        try:
            for batch in slices(batches, "text"):
                if stream is None:
                    fs.create_dir(root, recursive=True)
                    name = f"{root}/part-{part:06d}-{uuid.uuid4().hex[:12]}.rec"
                    stream = fs.open_output_stream(name)
                ids = [np.append(x, np.uint32(end_id)) for x in enc.encode(batch.column("text"))]
                keys = batch.column("doc_id").to_pylist()
                frames = frame([_sequence(k, x, width) for k, x in zip(keys, ids)])
                ends = at + np.cumsum([len(f) for f in frames])
                stream.write(b"".join(frames))
                n = len(keys)
                sizes = np.array([len(f) - FRAME_BYTES for f in frames], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array(np.arange(nth, nth + n)), pa.array(keys, pa.int64()), pa.array([name] * n), pa.array(ends - 4 - sizes), pa.array(sizes), pa.array([len(x) for x in ids], pa.int64())], names=["part", "nth", "doc_id", "file", "data_offset", "data_length", "n_tokens"])
                at, nth = int(ends[-1]), nth + n
        finally:
            if stream is not None:
                stream.close()

    return materialise(spark, rows.mapInArrow(write, INDEX_SCHEMA), "records-index")


def _sequence(key: int | None, ids: np.ndarray, width: int) -> bytes:
    return _DATA.pack(key or 0, key is None, width, 0) + ids.astype(f"<u{width}").tobytes()


def _parse(data: bytes) -> tuple[int | None, np.ndarray]:
    key, null, width, _ = _DATA.unpack_from(data)
    return None if null else key, np.frombuffer(data, f"<u{width}", offset=_DATA.size).astype("<u4")


def read_records(spark: SparkSession, index: DataFrame, folder: str | None = None) -> DataFrame:
    """Read every file of an index from its start, verify all checksums and return a row per record: its place, doc_id,
    the number of ids before it in its file, its own, and the crc32 of its ids as unsigned 32-bit little-endian."""
    files = index.groupBy("part", "file").agg(F.count("*").alias("n")).repartition(shuffle_partitions(spark), "part")
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]

    def read(batches):
        for batch in batches:
            for part, name, n in zip(*(batch.column(c).to_pylist() for c in ("part", "file", "n"))):
                with _file_system(folder, name).open_input_stream(name) as stream:
                    nth = start = 0
                    for datas in read_frames(stream):
                        parsed = [_parse(d) for d in datas]
                        sizes = np.array([len(x) for _, x in parsed], np.int64)
                        k = len(parsed)
                        yield pa.RecordBatch.from_arrays([pa.array([part] * k, pa.int32()), pa.array(np.arange(nth, nth + k)), pa.array([d for d, _ in parsed], pa.int64()), pa.array(start + np.cumsum(sizes) - sizes), pa.array(sizes), pa.array([zlib.crc32(x) for _, x in parsed], pa.int64())], names=names)
                        nth, start = nth + k, start + int(sizes.sum())
                if nth != n:
                    raise ValueError(f"{name} has {nth} records; the index has {n}")

    return files.mapInArrow(read, READ_SCHEMA)


def _file_system(folder: str | None, name: str):
    return file_system(folder)[0] if folder else file_system(name)[0]


def with_starts(spark: SparkSession, records: DataFrame, index: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all records before, over all files. The totals are a row per file, which is what goes
    through the driver."""
    total, base = 0, []
    for part, n in sorted(index.groupBy("part").agg(F.sum("n_tokens")).collect()):
        base.append((part, total))
        total += n
    bases = spark.createDataFrame(base, T.StructType([T.StructField("part", T.IntegerType()), T.StructField("base", T.LongType())]))
    return records.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("part_start")).drop("base")


def read_at(index_rows: list, folder: str | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """Shuffled read: seek to each given index row (file, data_offset, data_length) and return its doc_id and ids."""
    for row in index_rows:
        with _file_system(folder, row["file"]).open_input_file(row["file"]) as f:
            f.seek(row["data_offset"])
            data = f.read(row["data_length"])
            if masked_crc32c([data])[0] != struct.unpack("<I", f.read(4))[0]:
                raise ValueError("a record's checksum is wrong")
            yield _parse(data)


def token_records(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write docs as record files, read the files back: doc_id, start, n_tokens, ids_crc32 per document."""
    folder = scratch_path(spark, "records")
    index = write_records(spark, docs, tokenizer, end_id, folder)
    return with_starts(spark, read_records(spark, index, folder), index).select("doc_id", "start", "n_tokens", "ids_crc32")
