"""WARC archives as a Python data source: ``format("warc")``.

Writing: a row is a record; a task writes its records to one file per
``maxFileBytes`` under an attempt's own name, and only the commit of the whole
job renames them, so a retried task leaves nothing twice. Reading: files are
grouped into partitions of about ``partitionBytes``. Filters on record_type,
page_id, target_uri, payload_digest, refers_to and payload_bytes are pushed down:
a record's headers are parsed first, and if they fail a filter, or the option
``payload`` is false, its block is skipped by a seek and never decoded.

Archives of other writers, ``.warc`` or ``.warc.gz`` of one or many members, are read
too: record ids that are no page's give a null page_id (the id itself is record_id),
blocks that are no HTTP message are payloads as they are, and bytes that are no
UTF-8 are replaced. A compressed block is passed over without being decoded as text.

Files are reached through pyarrow's file systems (local or shared mounts,
hdfs, s3, gs), on the executors.
"""

from __future__ import annotations

import base64
import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from cohortlens.llm.shipping import ship
from cohortlens.session import ensure_checkpoint_dir
from cohortlens.sources.sizing import broadcast_if_small
from cohortlens.sources.stage_tables import materialize

SCHEMA = "page_id long, target_uri string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload string, record_id string"
#: Payloads of fewer bytes are always written out.
LEAST_REVISIT = 1000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 20


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _clean(value: str) -> str:
    """A header's value on one line; percent signs and line ends are escaped."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _restore(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int | None, uri: str | None, kind: str, digest: str, size: int, refers_to: int | None, payload: bytes) -> bytes:
    """One WARC/1.1 record. X-Payload-Length is the full payload's, which a revisit leaves out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", "WARC-Date: 1970-01-01T00:00:00Z"]
    head.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    if uri is not None:
        head.append(f"WARC-Target-URI: {_clean(uri)}")
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    head.append(f"X-Payload-Length: {size}")
    if kind == "revisit":
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def _page(value: str | None) -> int | None:
    """The page of a record id of ours; none of a foreign one, or one without a number."""
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if value != number and number.removeprefix("-").isascii() and number.removeprefix("-").isdigit() else None


class _Records:
    """The records of a file: headers first, blocks only on demand."""

    def __init__(self, file: pa.NativeFile, packed: bool = False) -> None:
        self.file = gzip.GzipFile(fileobj=file, mode="rb") if packed else file
        self.packed, self.held, self.at = packed, b"", 0

    def _fill(self, n: int) -> bool:
        """Hold more bytes from the place on; False at the end of the file."""
        more = self.file.read(n)
        self.held += more
        return bool(more)

    def _skip(self, n: int) -> None:
        """Go on by n bytes, by a seek where the file allows."""
        self.at += n
        held, self.held = len(self.held), self.held[n:]
        n -= held
        if n > 0 and not self.packed:
            self.file.seek(self.at)
        while n > 0 and self.packed and (more := self.file.read(min(n, _CHUNK))):
            n -= len(more)

    def __iter__(self) -> Iterator[tuple[dict[str, str], int, int]]:
        """(headers, block's offset, block's length)."""
        while self.held or self._fill(1024):
            while (end := self.held.find(b"\r\n\r\n")) < 0:
                if not self._fill(1024 if len(self.held) < 4096 else _CHUNK):
                    raise ValueError(f"a WARC record at byte {self.at} has no end of headers")
            lines = self.held[:end].decode(errors="replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no WARC record at byte {self.at}")
            headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
            length = int(headers["content-length"])
            self._skip(end + 4)
            start = self.at
            yield headers, start, length
            self._skip(start + length + 4 - self.at)

    def block(self, start: int, length: int) -> bytes:
        while len(self.held) < length and self._fill(length - len(self.held)):
            pass
        out = self.held[:length]
        self._skip(len(out))
        return out


@dataclass
class Files(InputPartition):
    paths: list[str]


def _fields(h: dict[str, str]) -> dict:
    """A record's columns, without its payload, from its headers."""
    uri = h.get("warc-target-uri")
    digest = h.get("warc-payload-digest", "")
    return {
        "page_id": _page(h.get("warc-record-id")),
        "target_uri": None if uri is None else _restore(uri),
        "record_type": h.get("warc-type"),
        "payload_digest": base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None,
        "payload_bytes": int(h["x-payload-length"]) if "x-payload-length" in h else None,
        "refers_to": _page(h.get("warc-refers-to")),
        "payload": None,
        "record_id": h.get("warc-record-id"),
    }


def _payload(headers: dict[str, str], block: bytes) -> str:
    """A block's text, without the head of an HTTP message."""
    if headers.get("content-type", "").startswith("application/http"):
        block = block.split(b"\r\n\r\n", 1)[-1]
    return block.decode(errors="replace")


_TESTS = {
    EqualTo: lambda x, v: x is not None and x == v,
    EqualNullSafe: lambda x, v: x == v,
    GreaterThan: lambda x, v: x is not None and x > v,
    GreaterThanOrEqual: lambda x, v: x is not None and x >= v,
    LessThan: lambda x, v: x is not None and x < v,
    LessThanOrEqual: lambda x, v: x is not None and x <= v,
    In: lambda x, v: x in v,
}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool, partition_bytes: int) -> None:
        self.path, self.payload, self.partition_bytes = path, payload, partition_bytes
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in (None, "payload") or type(f) not in (*_TESTS, IsNull, IsNotNull):
                yield f
            else:
                self.tests.append((type(f).__name__, name, getattr(f, "value", None)))

    def partitions(self) -> list[InputPartition]:
        fs, root = _open(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True)) if fs.get_file_info(root).type == pafs.FileType.Directory else [fs.get_file_info(root)]
        out, size = [Files([])], 0
        for f in sorted((f for f in found if f.path.endswith((".warc", ".warc.gz"))), key=lambda f: f.path):
            if size and size + f.size > self.partition_bytes:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(f.path)
            size += f.size
        return out

    def _wanted(self, row: dict) -> bool:
        for kind, name, value in self.tests:
            x = row[name]
            if kind in ("IsNull", "IsNotNull"):
                ok = (x is None) == (kind == "IsNull")
            else:
                ok = {t.__name__: f for t, f in _TESTS.items()}[kind](x, value)
            if not ok:
                return False
        return True

    def read(self, partition: Files) -> Iterator[tuple]:
        fs, _ = _open(self.path)
        for path in partition.paths:
            with fs.open_input_file(path) as file:
                records = _Records(file, path.endswith(".gz"))
                for headers, start, length in records:
                    row = _fields(headers)
                    if not self._wanted(row):
                        continue
                    if self.payload and row["record_type"] == "response":
                        row["payload"] = _payload(headers, records.block(start, length))
                    yield tuple(row.values())


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, max_file_bytes: int) -> None:
        self.path, self.max_file_bytes = path, max_file_bytes

    def write(self, iterator: Iterator) -> Written:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        for row in iterator:
            if out is None or size >= self.max_file_bytes:
                if out is not None:
                    out.close()
                names.append(f"part-{uuid.uuid4().hex}.warc")
                out, size = fs.open_output_stream(f"{root}/{names[-1]}.open"), 0
            payload = (row.payload or "").encode() if row.record_type == "response" else b""
            data = record(row.page_id, row.target_uri, row.record_type, row.payload_digest, row.payload_bytes, row.refers_to, payload)
            out.write(data)
            size += len(data)
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        for m in messages:
            for name in m.names if m else ():
                fs.move(f"{root}/{name}.open", f"{root}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.path)
        for m in messages:
            for name in m.names if m else ():
                if fs.get_file_info(f"{root}/{name}.open").type == pafs.FileType.File:
                    fs.delete_file(f"{root}/{name}.open")


class WarcSource(DataSource):
    """``path`` is required; ``payload``, ``partitionBytes`` and ``maxFileBytes`` are optional."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true") == "true", int(self.options.get("partitionbytes", 64 << 20)))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(self.options["path"], int(self.options.get("maxfilebytes", 64 << 20)))


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known, with filters pushed down."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def to_records(pages: DataFrame) -> DataFrame:
    """Rows of the source's schema for pages (page_id, url, html).

    Of pages with equal payloads of ``LEAST_REVISIT`` bytes or more, those with the
    largest page_id are responses, the others revisits of it; all smaller ones are
    responses. Null html is an empty payload; a null page_id is less than any
    other. Pages repeated with the same page_id are records each.
    """
    # The digest's group holds one row of combined maxima, however many pages share it.
    body = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("target_uri"), F.sha1(body.cast("binary")).alias("payload_digest"), F.octet_length(body).cast("long").alias("payload_bytes"), body.alias("payload")
    )
    most = rows.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("most"), F.count("*").alias("n"))
    # only digests that occur again, counted before they are sent to the pages; payloads are
    # shuffled to them only if they are too many for that
    most = materialize(most.where("n > 1 and most is not null").drop("n"))
    rows = rows.join(broadcast_if_small(most, 100 * most.count()), ["payload_digest", "payload_bytes"], "left")
    again = F.col("most").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("most"))
    return rows.select(
        "page_id", "target_uri", F.when(again, "revisit").otherwise("response").alias("record_type"), "payload_digest", "payload_bytes", F.when(again, F.col("most")).alias("refers_to"), F.when(~again, F.col("payload")).alias("payload"),
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")).alias("record_id"),
    )


def archive(pages: DataFrame, path: str) -> None:
    """Write the pages' records to WARC files under path."""
    register(pages.sparkSession)
    to_records(pages).write.format("warc").mode("append").save(path)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to an archive in the shared checkpoint folder and read it back:
    (page_id, payload_bytes, payload_digest, record_type, refers_to). Responses are
    measured and digested again from the payload read; revisits are read from
    their headers alone."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    archive(pages, path)
    back = spark.read.format("warc").option("path", path)
    whole = back.load().where("record_type = 'response'")
    body = F.col("payload").cast("binary")
    whole = whole.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1(body).alias("payload_digest"), "record_type", "refers_to")
    heads = back.option("payload", "false").load().where("record_type = 'revisit'")
    return whole.unionAll(heads.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
