"""WARC archives as a PySpark data source, for reading and writing.

    spark.dataSource.register(Warc)
    df.write.format("warc").mode("append").save(folder)
    spark.read.format("warc").schema("record_id string, payload binary").load(folder).filter("record_type = 'response'")

Reading.  The planner lists the files and packs them into partitions of about ``partition_bytes``; a file is never cut,
since a record may contain what looks like the start of another, so write archives of moderate size (``file_bytes`` when
written here).  Filters on the header columns (=, IN, starts with, not null, ANDed) go to the reader, which parses the
headers of a record first and steps over its block if a filter rejects it, or if neither payload nor payload_bytes is
asked for.  Filters on record_type can also be given as option ``types``.  Plain files and files with one gzip member
per record are read; members written here say how long they are (an extra field, as RFC 1952 allows), so that they
are skipped without being inflated; others are inflated in pieces that are thrown away.

Writing.  Every task writes files of its own under a temporary name; they get their final names only when the whole job
commits, and those of failed attempts are deleted.

Header values lose control characters when written; a null header is left out and read as null; a null payload counts
as empty.  An empty table gives no files, and a folder without archives reads as no rows.  Columns that the format does
not know are ignored when written.  Records of any length are streamed one at a time."""

from __future__ import annotations

import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceWriter, EqualTo, Filter,
                                    In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage)
from pyspark.sql.types import StructType

from contactloom.llm.shared import new_folder

#: Column of each header.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "profile": "WARC-Profile",
           "full_length": "X-Full-Payload-Length"}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", headers map<string, string>, payload binary, payload_bytes bigint"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x1f\x7f]+")
_NAME = re.compile(r"\.warc(\.gz)?$")
BLOCK = 1 << 16


def store(path: str):
    """File system and path of a folder, in any store that Arrow can open."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


@dataclass
class Files(InputPartition):
    paths: list[str]


class Pushed:
    """Header predicates: every one has to hold."""

    def __init__(self, types: str | None):
        self.tests: list[tuple[str, str, object]] = []
        if types:
            self.tests.append(("record_type", "in", frozenset(t.strip() for t in types.split(","))))

    def take(self, f: Filter) -> bool:
        column = getattr(f, "attribute", ("",))[0]
        if column not in HEADERS or len(f.attribute) > 1:
            return False
        if isinstance(f, EqualTo):
            self.tests.append((column, "in", frozenset([f.value])))
        elif isinstance(f, In):
            self.tests.append((column, "in", frozenset(f.value)))
        elif isinstance(f, StringStartsWith):
            self.tests.append((column, "starts", f.value))
        elif isinstance(f, IsNotNull):
            self.tests.append((column, "has", None))
        else:
            return False
        return True

    def keep(self, headers: dict[str, str]) -> bool:
        for column, kind, value in self.tests:
            own = headers.get(HEADERS[column].lower())
            if own is None or (kind == "in" and own not in value) or (kind == "starts" and not own.startswith(value)):
                return False
        return True


class Member:
    """One gzip member, or a plain file from here on, as a stream of inflated bytes."""

    def __init__(self, raw: BinaryIO, zipped: bool):
        self.raw, self.unzip, self.ready = raw, zlib.decompressobj(31) if zipped else None, b""

    def more(self) -> bool:
        """Make more bytes ready, a block at most; False at the end."""
        if self.unzip is None:
            chunk = self.raw.read(BLOCK)
            self.ready += chunk
            return bool(chunk)
        if self.unzip.eof:
            return False
        chunk = self.unzip.unconsumed_tail or self.raw.read(BLOCK)
        if not chunk:
            raise EOFError("an archive ends inside a record")
        self.ready += self.unzip.decompress(chunk, BLOCK)
        return True

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and with the mark; what is left if it does not come."""
        seen = 0
        while (at := self.ready.find(mark, seen)) < 0:
            seen = max(0, len(self.ready) - len(mark) + 1)
            if not self.more():
                at = len(self.ready)
                break
        out, self.ready = self.ready[:at + len(mark)], self.ready[at + len(mark):]
        return out

    def take(self, n: int) -> bytes:
        parts = []
        while n:
            if not self.ready and not self.more():
                raise EOFError("an archive ends inside a record")
            parts.append(self.ready[:n])
            self.ready = self.ready[n:]
            n -= len(parts[-1])
        return b"".join(parts)

    def step_over(self, n: int) -> None:
        """In a plain file: go on after n bytes without reading them."""
        if n > len(self.ready):
            self.raw.seek(n - len(self.ready), 1)
        self.ready = self.ready[n:]

    def leave(self) -> None:
        """Go to the end of the member, and stand there in the file."""
        while not self.unzip.eof:
            self.ready = b""
            self.more()
        self.raw.seek(-len(self.unzip.unused_data), 1)


def member_size(start: bytes) -> int:
    """Whole length of a gzip member if its extra field says so, else 0."""
    return int.from_bytes(start[16:20], "little") if len(start) == 20 and start[3] & 4 and start[12:16] == b"SL\x04\x00" else 0


def parse_headers(block: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    last = ""
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def records(raw: BinaryIO, pushed: Pushed, want_payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers and payload of the records that pass; of an HTTP response the payload is what follows its own headers."""
    zipped = raw.read(2) == b"\x1f\x8b"
    raw.seek(0)
    member = None if zipped else Member(raw, False)
    while True:
        if zipped:
            place, start = raw.tell(), raw.read(20)
            if not start:
                return
            raw.seek(place)
            member = Member(raw, True)
        head = member.until(b"\r\n\r\n")
        while head and not head.strip():  # empty lines between records
            head = member.until(b"\r\n\r\n")
        if head:
            headers = parse_headers(head.lstrip(b"\r\n"))
            length = int(headers.get("content-length", 0))
            if pushed.keep(headers):
                payload = member.take(length) if want_payload else None
                if payload and "application/http" in headers.get("content-type", ""):
                    payload = payload.partition(b"\r\n\r\n")[2]
                yield headers, payload
                length = 0 if want_payload else length
            if not zipped:
                member.step_over(length)
        if zipped and member_size(start):
            raw.seek(place + member_size(start))
        elif zipped:
            member.leave()
        elif not head:
            return


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.options = schema.names, dict(options)
        self.types = {f.name: f.dataType.simpleString() for f in schema}
        self.pushed = Pushed(self.options.get("types"))

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        return [f for f in filters if not self.pushed.take(f)]

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        disk, path = store(self.options["path"])
        found = disk.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=True))
        found = sorted((f.path, f.size) for f in found if f.is_file and _NAME.search(f.path) and not f.base_name.startswith((".", "_")))
        target = int(self.options.get("partition_bytes", 64 << 20))
        out, size = [], target
        for name, n in found:
            if size + n > target:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(name)
            size += n
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        disk, _ = store(self.options["path"])
        want = bool({"payload", "payload_bytes"} & set(self.names))
        kinds = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64(), "map<string,string>": pa.map_(pa.string(), pa.string())}
        schema = pa.schema([(n, kinds[self.types[n]]) for n in self.names])
        rows: list[tuple] = []
        size = 0
        for path in partition.paths:
            with io.BufferedReader(disk.open_input_file(path), 1 << 18) as raw:
                for headers, payload in records(raw, self.pushed, want):
                    given = {"headers": list(headers.items()), "payload": payload,
                             "payload_bytes": None if payload is None else len(payload)}
                    rows.append(tuple(given[n] if n in given else headers.get(HEADERS[n].lower()) for n in self.names))
                    size += 1000 + len(payload or b"")
                    if size > 8 << 20:
                        yield self.batch(rows, schema)
                        rows, size = [], 0
        yield self.batch(rows, schema)

    @staticmethod
    def batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


def record_bytes(row: dict) -> bytes:
    """A record: its headers, and for a response the payload as the body of an HTTP answer."""
    head = [(name, row.get(column)) for column, name in HEADERS.items()]
    if row.get("record_type") == "revisit":
        block = b""
    else:
        payload = row.get("payload") or b""
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
        head.append(("Content-Type", "application/http; msgtype=response"))
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{n}: {_CONTROL.sub(' ', v)}\r\n" for n, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def zip_member(raw: bytes) -> bytes:
    """One gzip member whose extra field holds its whole length."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = squeeze.compress(raw) + squeeze.flush()
    size = 20 + len(body) + 8
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + (8).to_bytes(2, "little") + b"SL\x04\0" + size.to_bytes(4, "little") + body
            + zlib.crc32(raw).to_bytes(4, "little") + (len(raw) & 0xFFFFFFFF).to_bytes(4, "little"))


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.options = dict(options)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        disk, path = store(self.options["path"])
        disk.create_dir(path, recursive=True)
        zipped = self.options.get("compression", "gzip") == "gzip"
        most = int(self.options.get("file_bytes", 64 << 20))
        files: list[tuple[str, str]] = []
        out, size = None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size >= most:
                        if out is not None:
                            out.close()
                        name = f"{uuid.uuid4().hex}.warc" + ".gz" * zipped
                        files.append((f"{path}/.{name}", f"{path}/{name}"))
                        out, size = disk.open_output_stream(files[-1][0], compression=None), 0
                    raw = record_bytes(row)
                    raw = zip_member(raw) if zipped and len(raw) < 1 << 31 else raw
                    out.write(raw)
                    size += len(raw)
        except BaseException:
            for hidden, _ in files:
                disk.delete_file(hidden)
            raise
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        disk, _ = store(self.options["path"])
        for message in messages:
            for hidden, name in message.files if message else ():
                disk.move(hidden, name)

    def abort(self, messages: list[Written | None]) -> None:
        disk, _ = store(self.options["path"])
        for message in messages:
            for hidden, _ in message.files if message else ():
                disk.delete_file(hidden)


class Warc(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("archives are only appended to; choose another folder")
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known, and let filters go down to data sources in Python."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Warc)


RECORD = "<urn:page:"


def archive_pages(pages: DataFrame, folder: str, least: int = 100, date: str = "2020-01-01T00:00:00Z") -> None:
    """One record per page.  Of pages with the same payload of at least ``least`` bytes, that with the smallest page_id
    is written as a response and the others as revisits of it; pages that share that smallest id (repeated rows) are
    responses each.  A page without id comes after all with one; where no page of a group has an id, all are responses."""
    spark = pages.sparkSession
    register(spark)
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")).select(
        "*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("n"))
    groups = (rows.filter(F.col("n") >= least).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("size"))
              .filter("size > 1 AND first_id IS NOT NULL").select("digest", "first_id"))
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    name = lambda c: F.concat(F.lit(RECORD), F.coalesce(F.col(c).cast("string"), F.lit("-")), F.lit(">"))
    marked = rows.join(groups, "digest", "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), name("page_id").alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(revisit, name("first_id")).alias("refers_to"), F.when(revisit, SAME_PAYLOAD).alias("profile"),
        F.col("n").cast("string").alias("full_length"), F.when(~revisit, F.col("payload")).alias("payload"))
    marked.write.format("warc").mode("append").save(folder)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The pages of such archives: of responses, length and digest are worked out from the payload that was read, of
    revisits they are what the headers say."""
    register(spark)
    read = spark.read.format("warc").schema(
        "record_type string, record_id string, refers_to string, payload_digest string, full_length string, payload binary").load(folder)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")
    own = F.col("record_type") == "response"
    return read.filter(F.col("record_type").isin("response", "revisit")).select(
        page("record_id").alias("page_id"),
        F.when(own, F.octet_length("payload")).otherwise(F.col("full_length")).cast("bigint").alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.regexp_replace("payload_digest", "^sha256:", "")).alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_pages(spark, folder)


OP4_SQL = """
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest,
             min(page_id) OVER (PARTITION BY sha256(coalesce(html, ''))) AS first_id FROM pages) AS p"""
