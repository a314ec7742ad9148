"""WARC output with revisit resolution, and reading of such archives.

Only headers (page_id, url, digest, size) are shuffled by payload digest, to find each digest's original: the record with
the smallest page_id (null last), then the smallest url. A digest's minimum is aggregated before the shuffle; the join of
the others to it is an inner join of two plain tables that adaptive execution splits where a digest is hot. The bodies then
meet their resolved headers by page_id and are written once per distinct payload, all others as revisit records.

Edge cases: null html counts as empty, null url as an empty one; of rows that are equal in page_id, url and html, one is
written first and the others revisit it; a null page_id has no X-Page-Id header and reads back as null; an empty table
gives no archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import file_system, materialise, slices
from tabflow.session import scratch_path, shuffle_partitions

READ_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, record_offset long"
INDEX_SCHEMA = "file string, records long"


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages (page_id, url, html) with the original's page_id and url for rows that revisit one; is_revisit marks them.

    Rows are dealt by (page_id, url, digest) and sorted so. Rows equal to their original in all three stay unmarked; the
    writer, which gets them side by side, keeps the first as response."""
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha1("body")).withColumn("page", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    headers = rows.select("page", "page_id", "url", "digest", F.octet_length("body").alias("size")).where(F.col("size") >= min_bytes)
    first = headers.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("n"), "page_id", "url")).alias("o"))
    same = F.col("page_id").eqNullSafe(F.col("o.page_id")) & (F.col("url") == F.col("o.url"))
    revisits = headers.drop("size").distinct().join(first, "digest").where(~same).select(
        "page", "url", "digest", F.col("o.page_id").alias("refers_to"), F.col("o.url").alias("refers_url"), F.lit(True).alias("is_revisit"))
    keys = ["page", "url", "digest"]
    dealt = rows.repartition(shuffle_partitions(pages.sparkSession), *keys)
    joined = dealt.join(revisits, keys, "left").withColumn("is_revisit", F.coalesce("is_revisit", F.lit(False)))
    return joined.sortWithinPartitions(*keys).select("page_id", "url", "body", "digest", F.octet_length("body").alias("size"), "refers_to", "refers_url", "is_revisit")


def _url(url: str) -> str:
    """A URL as one header value: blanks and control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _record_id(page_id: int | None, url: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url}')}>"


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def write_archives(resolved: DataFrame, folder: str, date: str) -> DataFrame:
    """Write resolved pages as one compressed archive per partition (a gzip member per record) with fresh headers; returns
    a row per archive. A task writes to a name of its own, and only committed rows name archives."""
    def write(batches):
        fs, root = file_system(folder)
        out, n, last, name = None, 0, None, f"{root}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.gz"
        try:
            for batch in slices(batches, "body"):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(name, compression=None)
                    info = "software: tabflow\r\nformat: WARC File Format 1.1\r\n".encode()
                    out.write(gzip.compress(_record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], info), 6, mtime=0))
                for r in batch.to_pylist():
                    own = (r["page_id"], r["url"], r["digest"])
                    again = not r["is_revisit"] and r["repeats"] and own == last  # a repeated row
                    last = own
                    origin = (r["refers_to"], r["refers_url"]) if r["is_revisit"] else own[:2] if again else None
                    head = [("WARC-Record-ID", _record_id(*own)), ("WARC-Date", date), ("WARC-Target-URI", _url(r["url"])), ("WARC-Payload-Digest", f"sha1:{_base32(r['digest'])}"), ("Content-Type", "application/http; msgtype=response")]
                    if r["page_id"] is not None:
                        head.append(("X-Page-Id", str(r["page_id"])))
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(r['body'])}\r\n\r\n".encode()
                    if origin:
                        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _record_id(*origin, r["digest"])), ("WARC-Refers-To-Target-URI", _url(origin[1])), ("WARC-Refers-To-Date", date)]
                        if origin[0] is not None:
                            head.append(("X-Refers-To-Page-Id", str(origin[0])))
                        record = _record("revisit", head, http)
                    else:
                        record = _record("response", head, http + r["body"])
                    out.write(gzip.compress(record, 6, mtime=0))
                    n += 1
        finally:
            if out is not None:
                out.close()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["file", "records"])

    return resolved.mapInArrow(write, INDEX_SCHEMA)


def _members(stream) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member; a member holds one record."""
    at, begin, unzip, parts, data = 0, 0, zlib.decompressobj(31), [], stream.read(1 << 20)
    while data:
        parts.append(unzip.decompress(data))
        if unzip.eof:
            rest = unzip.unused_data
            at += len(data) - len(rest)
            yield begin, b"".join(parts)
            begin, parts, unzip, data = at, [], zlib.decompressobj(31), rest or stream.read(1 << 20)
        else:
            at += len(data)
            data = stream.read(1 << 20)
    if parts:
        raise ValueError("the archive ends within a record")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Read archives back, a row per response or revisit record. A response's digest and size are computed from its
    payload and held against its headers; a revisit record's come from its headers, which stand for the original's."""
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def read(batches):
        for batch in batches:
            for name, n in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist()):
                rows, seen = [], 0
                with file_system(folder)[0].open_input_stream(name, compression=None) as stream:
                    for at, record in _members(stream):
                        head, _, block = record.partition(b"\r\n\r\n")
                        h = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        block = block[: int(h["Content-Length"])]
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if h["WARC-Type"] == "response" and (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()) != (size, digest):
                            raise ValueError(f"the payload at {at} of {name} is not what its headers say")
                        page, refers = (int(h[k]) if k in h else None for k in ("X-Page-Id", "X-Refers-To-Page-Id"))
                        rows.append((page, h["WARC-Target-URI"], size, digest, h["WARC-Type"], refers, name, at))
                        seen += 1
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                            rows = []
                if seen != n:
                    raise ValueError(f"{name} has {seen} records; {n} were written")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return archives.repartition(shuffle_partitions(archives.sparkSession), "file").mapInArrow(read, READ_SCHEMA)


def deduplicated_archives(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", folder: str | None = None) -> DataFrame:
    """Write pages as archives, identical payloads of at least min_bytes once, and read them back."""
    folder = folder or scratch_path(spark, "warc")
    rows = resolve(pages, min_bytes).withColumn("repeats", F.col("size") >= min_bytes)
    archives = materialise(spark, write_archives(rows, folder, date), "warc-index")
    return read_archives(archives, folder)
