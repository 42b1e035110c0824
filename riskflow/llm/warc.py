"""WARC archives as a Python data source: writer, planned reader, and pages with revisit records.

The writer stores each record as a gzip member of its own whose header says how long the member is
(an ``sl`` extra field), so a reader can step over a record without inflating it. A commit
lists the files that count; files of failed or repeated attempts are never read.

The reader packs whole files into partitions, takes predicates on the record type and on
the header columns, parses a record's header first, and inflates the payload only of records that
pass and only if the schema asks for it. Plain files and gzip without the extra field are read too.

* a null payload is empty; payloads of one record are held whole, records one at a time;
* equal payloads of at least ``least_bytes``: the largest ``page_id`` is the response, the others
  revisit it; rows that share that id and payload are all responses; a null id is the smallest;
* an empty table writes no file and reads back as no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from riskflow.llm.common import kept_table
from riskflow.session import shared_folder

# Fixed names of the format.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
    "content_type": "Content-Type",
}
SCHEMA = ", ".join(f"{name} string" for name in HEADERS) + ", payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
#: Bytes inflated at a time until a header is whole.
HEAD = 1024


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def digest_name(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(fields: dict[str, str | None], payload: bytes | None) -> bytes:
    """One record: WARC header, HTTP header, payload. A revisit has the HTTP header alone."""
    http = b""
    if fields["record_type"] in ("response", "revisit"):
        length = fields.get("payload_length") or str(len(payload or b""))
        http = f"HTTP/1.1 200 OK\r\nContent-Type: {fields.get('content_type') or 'text/html; charset=utf-8'}\r\nContent-Length: {length}".encode() + END
    block = http + (payload or b"")
    lines = ["WARC/1.1"]
    for name, header in HEADERS.items():
        value = fields.get(name)
        if value is not None and name != "content_type":
            lines.append(f"{header}: {value.replace(chr(13), ' ').replace(chr(10), ' ')}")
    if fields["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    lines.append("Content-Type: application/http; msgtype=response" if http else "Content-Type: application/warc-fields")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + END + block + END


def gzip_member(data: bytes, level: int) -> bytes:
    """A gzip member that carries its own length, where that fits into 32 bits."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    tail = zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")
    whole = 10 + 2 + 12 + len(body) + len(tail)
    if max(whole, len(data)) >> 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\x00\xff" + body + tail
    extra = b"sl" + (8).to_bytes(2, "little") + whole.to_bytes(4, "little") + len(data).to_bytes(4, "little")
    return b"\x1f\x8b\x08\x04\0\0\0\0\x00\xff" + len(extra).to_bytes(2, "little") + extra + body + tail


def parse_header(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


class _Member:
    """One record of a file: its header at once, its block when asked for."""

    def __init__(self, source: pa.NativeFile, start: int) -> None:
        self.source, self.start = source, start
        source.seek(start)
        head = source.read(4096)
        if not head.strip(b"\r\n\0"):
            self.header = None
            return
        self.zipped = head[:2] == b"\x1f\x8b"
        self.end: int | None = None
        if self.zipped:
            if head[3] & 4 and head[12:14] == b"sl":
                self.end = start + int.from_bytes(head[16:20], "little")
            self.inflate = zlib.decompressobj(31)
            self.data = self.inflate.decompress(head, HEAD)
        else:
            self.data = head
        while (cut := self.data.find(END)) < 0 and self._more():
            pass
        self.header = parse_header(self.data[:cut] if cut >= 0 else self.data)
        self.data = self.data[cut + 4 :]
        self.length = int(self.header.get("content-length", "0"))
        if not self.zipped:
            self.end = start + cut + 4 + self.length + 4

    def _more(self) -> bool:
        piece = self._next(HEAD)
        self.data += piece or b""
        return piece is not None

    def _next(self, most: int) -> bytes | None:
        """The next bytes of the record, at most so many if it is compressed; None at its end."""
        if not self.zipped:
            return self.source.read(most) or None
        if self.inflate.eof:
            return None
        piece = self.inflate.unconsumed_tail or self.source.read(1 << 16)
        return self.inflate.decompress(piece, most) if piece else None

    def block(self) -> bytes:
        parts, size = [self.data], len(self.data)
        while size < self.length:
            piece = self._next(1 << 18)
            if piece is None:
                raise ValueError("a record ends before its length")
            parts.append(piece)
            size += len(piece)
        self.data = b"".join(parts)
        return self.data[: self.length]

    def next_start(self) -> int:
        """Known from the header; a gzip member without its length is inflated to its end."""
        if self.end is None:
            while self._next(1 << 18) is not None:
                pass
            self.end = self.source.tell() - len(self.inflate.unused_data)
        return self.end


def read_records(source: pa.NativeFile, wanted, with_payload: bool) -> Iterator[dict]:
    """Header columns, and the payload if asked for, of the records whose header passes."""
    at, size = 0, source.size()
    while at < size:
        member = _Member(source, at)
        if member.header is None:
            return
        row = {name: member.header.get(header.lower()) for name, header in HEADERS.items()}
        if wanted(row):
            if with_payload and row["record_type"] != "revisit":
                block = member.block()
                http, found, payload = block.partition(END) if block.startswith(b"HTTP/") else (b"", b"", block)
                row["payload"] = payload if found or not http else b""
            yield row
        at = member.next_start()


@dataclass
class Committed(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        if overwrite:
            raise ValueError("archives are only added to")
        self.path = options["path"].rstrip("/")
        self.level = int(options.get("level", "1"))
        self.file_bytes = int(options.get("file_bytes", 64 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Committed:
        store, folder = open_store(self.path)
        files, out, size = [], None, 0
        for batch in iterator:
            names = [n for n in HEADERS if n in batch.schema.names]
            for row in zip(batch.column("payload"), *[batch.column(n).to_pylist() for n in names]):
                payload = row[0].as_buffer()
                member = gzip_member(record_bytes(dict.fromkeys(HEADERS) | dict(zip(names, row[1:])), payload.to_pybytes() if payload else None), self.level)
                if out is None:
                    store.create_dir(folder, recursive=True)
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
                out.write(member)
                size += len(member)
                if size >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Committed(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = open_store(self.path)
        store.create_dir(folder, recursive=True)
        files = sorted(f for m in messages if m for f in m.files)
        with store.open_output_stream(f"{folder}/_committed-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files of an aborted write are on no list, so nobody reads them."""


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.path = options["path"].rstrip("/")
        self.partition_bytes = int(options.get("partition_bytes", 16 << 20))
        self.names = [f.name for f in schema.fields]
        self.schema = pa.schema([(n, pa.binary() if n == "payload" else pa.string()) for n in self.names])
        self.filters: list[tuple] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take what a header decides; Spark keeps the rest."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, (EqualTo, In, IsNull, IsNotNull, StringStartsWith)):
                self.filters.append((type(f).__name__, column, getattr(f, "value", None)))
            else:
                yield f

    def _passes(self, row: dict) -> bool:
        for kind, column, value in self.filters:
            own = row[column]
            if kind == "IsNull":
                ok = own is None
            elif kind == "IsNotNull":
                ok = own is not None
            elif own is None:
                ok = False
            elif kind == "EqualTo":
                ok = own == value
            elif kind == "In":
                ok = own in value
            else:
                ok = own.startswith(value)
            if not ok:
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        store, folder = open_store(self.path)
        found = store.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        lists = [f for f in found if f.base_name.startswith("_committed-")]
        files = {f.base_name: f.size for f in found if f.base_name.endswith((".warc", ".warc.gz"))}
        if lists:
            named = [name for f in lists for name in json.loads(store.open_input_stream(f.path, compression=None).read())]
            files = {name: files[name] for name in named}
        parts, held = [], 0
        for name, size in sorted(files.items()):
            if not parts or held + size > self.partition_bytes:
                parts.append(Files([]))
                held = 0
            parts[-1].paths.append(f"{folder}/{name}")
            held += size
        return parts or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.path)
        rows, held = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as source:
                for row in read_records(source, self._passes, "payload" in self.names):
                    rows.append({n: row.get(n) for n in self.names})
                    held += len(row.get("payload") or b"") + 500
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, self.schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, self.schema)


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``; options path, partition_bytes; for writing level, file_bytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Register the source; predicates reach a Python source only with Spark's own switch on."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_warc(records: DataFrame, path: str, **options) -> None:
    """Write rows with any of the header columns and ``payload``."""
    register(records.sparkSession)
    records.write.format("warc").mode("append").options(**options).save(path)


def read_warc(spark: SparkSession, path: str, schema: str = SCHEMA, **options) -> DataFrame:
    """Records as rows; leave ``payload`` out of the schema to inflate headers only."""
    register(spark)
    return spark.read.format("warc").schema(schema).options(**options).load(path)


def page_records(pages: DataFrame, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """WARC records of pages, equal payloads as one response and revisits.

    The join with repeated payloads is on two fresh exchanges, so adaptive execution can split
    a payload that many pages share.
    """
    payload = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("bytes", F.octet_length("payload").cast("long"))
    repeated = rows.where(F.col("bytes") >= least_bytes).groupBy("sha1").agg(F.max("page_id").alias("newest"), F.count("*").alias("many")).where("many > 1")
    repeated = kept_table(repeated.select("sha1", "newest"), "repeated-payloads")
    joined = rows.join(repeated, "sha1", "left")
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return joined.select(
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.when(revisit, F.concat(F.lit("<urn:page:"), "newest", F.lit(">"))).alias("refers_to"),
        F.concat(F.lit("sha1:"), base32(F.col("sha1"))).alias("payload_digest"),
        F.col("bytes").cast("string").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def base32(hex_digits):
    """Base32 of 40 hex digits: five of them are four characters."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for group in range(8):
        number = F.conv(F.substring(hex_digits, 5 * group + 1, 5), 16, 10).cast("int")
        out += [F.substr(alphabet, F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*out)


def archived_pages(pages: DataFrame, least_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write all pages as records, read the archives back, one row per page.

    A response's length and digest are those of the payload as it was read.
    """
    spark = pages.sparkSession
    path = path or shared_folder(spark, "warc")
    write_warc(page_records(pages, least_bytes), path)
    back = read_warc(spark, path).where(F.col("record_type").isin("response", "revisit"))
    number = r"^<urn:page:(-?\d+)>$"
    is_response = F.col("record_type") == "response"
    return back.select(
        F.regexp_extract("record_id", number, 1).try_cast("long").alias("page_id"),
        F.when(is_response, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(is_response, base32(F.sha1("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        F.regexp_extract("refers_to", number, 1).try_cast("long").alias("refers_to"),
    )
