"""WARC archives as a Spark data source.

``spark.read.format("warc")`` plans partitions of whole files by size, evaluates pushed equality
predicates on record type and headers, and parses headers first: a record that is not wanted, or
whose payload is not, is skipped without decoding its payload. Archives are gzip members, one
per record, that carry their compressed length in the ``sl`` extra field, so skipping needs no
decompression; members without it and plain archives are read as well.

Files are reached by pyarrow's file systems (local, S3, GCS, HDFS), the same on driver and tasks. A
task writes below ``_temporary`` and the job's commit moves the files of its successful
attempts, so lost or repeated tasks leave no records behind.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    WriterCommitMessage,
)

SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
    "headers map<string,string>, payload binary"
)
# Fixed values of the format.
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
IN_BRACKETS = ("record_id", "refers_to")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP, EXTRA = b"\x1f\x8b\x08", 4
BATCH_BYTES = 8 << 20
SAFE = "".join(map(chr, range(33, 127)))


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def record_bytes(row: dict, level: int) -> bytes:
    """One record as a gzip member. Header values are percent-encoded where they are not printable ASCII."""
    payload = row.get("payload") or b""
    revisit = row["record_type"] == "revisit"
    lines = ["WARC/1.1"]
    for column, name in FIELDS.items():
        if (value := row.get(column)) is not None:
            value = quote(value, safe=SAFE)
            lines.append(f"{name}: <{value}>" if column in IN_BRACKETS else f"{name}: {value}")
    if revisit:
        lines.append(f"WARC-Profile: {PROFILE}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response"]
    data = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = struct.pack("<2sHII", b"sl", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    head = GZIP + bytes([EXTRA]) + b"\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class _Member:
    """Decoded bytes of one gzip member, read as far as asked."""

    def __init__(self, stream, first: bytes):
        self.stream, self.out, self.ended = stream, b"", False
        head = first + stream.read(10 - len(first))
        self.fed = head
        self.left = None
        if head[3] == EXTRA:
            size = stream.read(2)
            extra = stream.read(struct.unpack("<H", size)[0])
            self.fed += size + extra
            at = 0
            while at + 4 <= len(extra):
                name, n = struct.unpack_from("<2sH", extra, at)
                if name == b"sl" and n == 8:
                    self.left = struct.unpack_from("<I", extra, at + 4)[0] - len(self.fed)
                at += 4 + n
        self.inflate = zlib.decompressobj(31)
        self.pending = self.fed

    def until(self, enough) -> bytes:
        while not self.ended and not enough(self.out):
            data, self.pending = self.pending, b""
            if not data:
                want = 1 << 16 if self.left is None else min(1 << 16, self.left)
                data = self.stream.read(want)
                if not data:
                    raise ValueError("a gzip member ends early")
                if self.left is not None:
                    self.left -= len(data)
            self.out += self.inflate.decompress(data, 1 << 16)
            self.pending = self.inflate.unconsumed_tail
            self.ended = self.inflate.eof
        return self.out

    def rest(self) -> bytes:
        """All bytes; with a known length in one read."""
        if self.left:
            more = self.stream.read(self.left)
            self.left = 0
            parts = [self.out, self.inflate.decompress(self.pending + more), self.inflate.flush()]
            self.out, self.ended, self.pending = b"".join(parts), True, b""
            return self.out
        return self.until(lambda _: False)

    def skip(self) -> bytes:
        """Move behind the member; returns bytes already read of the next one."""
        if self.left is not None:
            if self.left:
                self.stream.seek(self.stream.tell() + self.left)
            return b""
        while not self.ended:
            self.out = b""
            self.until(lambda out: len(out) > 1 << 20)
        return self.inflate.unused_data


class _Joined:
    """A stream with bytes put back in front."""

    def __init__(self, stream):
        self.stream, self.front = stream, b""

    def read(self, n: int) -> bytes:
        data, self.front = self.front[:n], self.front[n:]
        return data + self.stream.read(n - len(data)) if len(data) < n else data

    def tell(self) -> int:
        return self.stream.tell() - len(self.front)

    def seek(self, to: int) -> None:
        self.front = b""
        self.stream.seek(to)


def parse_headers(data: bytes) -> tuple[dict[str, str], int]:
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k: v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}, end + 4


def field(headers: dict[str, str], column: str) -> str | None:
    value = headers.get(FIELDS[column])
    return value.strip("<>") if value is not None and column in IN_BRACKETS else value


def read_records(stream, wanted, payloads: bool) -> Iterator[tuple]:
    """Rows of the schema from an archive; ``wanted`` decides on the headers."""
    stream = _Joined(stream)
    done = lambda out: b"\r\n\r\n" in out
    while first := stream.read(1):
        if first in b"\r\n":
            continue
        if first == GZIP[:1]:
            member = _Member(stream, first)
            headers, at = parse_headers(member.until(done))
            block = None
            if wanted(headers) and payloads:
                data = member.rest()
                block = data[at : at + int(headers["Content-Length"])]
            stream.front = member.skip() + stream.front
        else:
            data = first
            while not done(data):
                more = stream.read(1 << 12)
                if not more:
                    raise ValueError("a record ends early")
                data += more
            headers, at = parse_headers(data)
            stream.front = data[at:] + stream.front
            size = int(headers["Content-Length"])
            block = None
            if wanted(headers) and payloads:
                block = stream.read(size)
            else:
                stream.seek(stream.tell() + size)
        if wanted(headers):
            payload = None
            if block is not None and field(headers, "record_type") != "revisit":
                http = block.startswith(b"HTTP/")
                payload = block[block.index(b"\r\n\r\n") + 4 :] if http else block
            yield (*(field(headers, c) for c in FIELDS), headers, payload)


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payloads = options.get("payload", "true").lower() != "false"
        self.target = int(options.get("partitionbytes", 64 << 20))
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name not in FIELDS:
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[name] = self.wanted.get(name, values) & values

    def partitions(self):
        system, root = file_system(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted(
            (f.path, f.size)
            for f in found
            if f.is_file and f.path.endswith((".warc", ".warc.gz")) and "/_" not in f.path[len(root) :]
        )
        parts, own, size = [], [], 0
        for path, n in files:
            if own and size + n > self.target:
                parts.append(Files(tuple(own)))
                own, size = [], 0
            own.append(path)
            size += n
        return [*parts, Files(tuple(own))]

    def read(self, partition):
        system, _ = file_system(self.path)
        kinds = pa.schema([*((c, pa.string()) for c in FIELDS), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [
                pa.array([list(x.items()) for x in c] if k.name == "headers" else c, k.type)
                for c, k in zip(columns, kinds, strict=True)
            ]
            return pa.RecordBatch.from_arrays(arrays, schema=kinds)

        fits = lambda h: all(field(h, c) in v for c, v in self.wanted.items())
        for path in partition.paths:
            with system.open_input_file(path) as stream:
                for row in read_records(stream, fits, self.payloads):
                    rows.append(row)
                    held += len(row[-1] or b"") + 500
                    if held > BATCH_BYTES:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.level = int(options.get("level", 1))
        self.file_bytes = int(options.get("filebytes", 1 << 30))
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator):
        system, root = file_system(self.path)
        folder = f"{root}/_temporary/{self.job}"
        system.create_dir(folder, recursive=True)
        names, stream, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if stream is None or size > self.file_bytes:
                    if stream is not None:
                        stream.close()
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    stream, size = system.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
                data = record_bytes(row, self.level)
                stream.write(data)
                size += len(data)
        if stream is not None:
            stream.close()
        return Written(tuple(names))

    def commit(self, messages):
        system, root = file_system(self.path)
        folder = f"{root}/_temporary/{self.job}"
        if self.overwrite:
            for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if f.is_file:
                    system.delete_file(f.path)
        for message in messages:
            for name in message.names if message else ():
                system.move(f"{folder}/{name}", f"{root}/{name}")
        self._clear(system, folder)

    def abort(self, messages):
        system, root = file_system(self.path)
        self._clear(system, f"{root}/_temporary/{self.job}")

    @staticmethod
    def _clear(system, folder: str) -> None:
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Records of ``pages`` (page_id, url, html); further columns are ignored.

    The payload is the html in UTF-8, empty for null. Of records with equal payloads of at least
    ``least_bytes`` that with the smallest ``page_id`` is the response and the others revisit it.
    Repeated rows of that page, and rows without ``page_id``, are responses. A null url is left out.
    Only repeated digests are joined back; the join splits a digest that very many pages have.
    """
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("payload_digest", F.sha2("payload", 256))
    first = (
        pages.where(F.length("payload") >= least_bytes).groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    revisit = F.col("page_id") != F.col("first")
    return pages.join(first, "payload_digest", "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))).alias("record_id"),
        "target_uri",
        F.when(revisit, F.concat(F.lit("urn:page:"), F.col("first").cast("string"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "payload_digest").alias("payload_digest"),
        F.when(revisit, F.lit(None)).otherwise(F.col("payload")).alias("payload"),
    )


def write_archives(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Records below ``path``. Spark keeps the pushed filters of a Python source with the loaded frame, so each
    differently filtered use of the archives needs a load of its own.
    """
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of archives made from pages: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Sizes and digests come from the decoded payloads; those of a revisit from the response it refers to.
    """
    page = lambda c: F.substring_index(c, ":", -1).try_cast("long")
    responses = read_archives(spark, path).where("record_type = 'response'").select(
        "record_type", "record_id", "refers_to", F.length("payload").cast("long").alias("size"),
        F.sha2("payload", 256).alias("digest"),
    )
    known = responses.groupBy(F.col("record_id").alias("refers_to"), F.concat(F.lit("sha256:"), "digest").alias("payload_digest")).agg(
        F.max("size").alias("size"), F.max("digest").alias("digest")
    )
    revisits = read_archives(spark, path, payload=False).where("record_type = 'revisit'").select(
        "record_type", "record_id", "refers_to", "payload_digest"
    ).join(known, ["refers_to", "payload_digest"], "left").drop("payload_digest")
    return responses.unionByName(revisits).select(
        page("record_id").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"),
    )
