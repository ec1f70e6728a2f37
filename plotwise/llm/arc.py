"""Legacy ARC archives, and their conversion to WARC.

``write_arc`` puts pages into ARC files of version 1 or 2, one gzip member per record.
``read_arc`` parses them: the version block says which header line follows, and each record
is as long as its header declares. ``convert`` rewrites every file as WARC: record ids,
timestamps and types are made from what the ARC header holds, digests from the content.
Of records with equal payloads of at least ``REVISIT_BYTES``, that with the smallest page
id becomes a response, the others revisit it; Spark finds it by grouping digests, so no
task sees more than sums of a digest's records. ``read_warc`` parses and verifies.

A page's id travels in the HTTP head of its record. Null html is an empty payload, a null
url becomes ``urn:page:`` and the id, a null id stays null and counts as the largest. Of
repeated rows, the first in file order is the response. An empty table makes no file.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import urllib.parse
import uuid
from collections.abc import Iterable, Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import columns, records, ship, slices
from plotwise.llm.idfile import make_folder
from plotwise.session import new_folder, staged

#: Bytes of records after which a file is closed.
FILE_BYTES = 32 << 20
REVISIT_BYTES = 100
LEVEL = 4

# Fixed values of the two formats.
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
          2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
PAYLOAD_LENGTH = "X-Payload-Length"  # of a revisit, whose block may hold no head
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

ARC_FILES = pa.schema([("file", pa.string()), ("records", pa.int64())])
ARC_RECORDS = pa.schema([("file", pa.string()), ("number", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                         ("payload_digest", pa.string()), ("record_id", pa.string())])
WARC_RECORDS = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                          ("record_type", pa.string()), ("refers_to_id", pa.string()), ("url", pa.string()), ("date", pa.string())])


def schema_of(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in schema)


def uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else "file://" + folder


class Record(NamedTuple):
    """One ARC record; ``content`` is what came over the network, HTTP head included."""

    url: str
    ip: str
    date: str
    mime: str
    content: bytes


def http(content: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Fields (lower-case names), head with its empty line, and payload; without a head all is payload."""
    if not content.startswith(b"HTTP/"):
        return {}, b"", content
    head, mark, payload = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("latin-1").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, head + mark, payload


def page_id(fields: dict[str, str]) -> int | None:
    return int(fields["x-page-id"]) if "x-page-id" in fields else None


# -- ARC

def version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 plotwise\n{FIELDS[version]}\n".encode()
    line = f"filedesc://{name} 0.0.0.0 {date} text/plain " + (f"200 - - 0 {name} " if version == 2 else "")
    return f"{line}{len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, record: Record, offset: int, name: str) -> bytes:
    more = f"200 {hashlib.md5(record.content).hexdigest()} - {offset} {name} " if version == 2 else ""
    return f"{record.url} {record.ip} {record.date} {record.mime} {more}{len(record.content)}\n".encode() + record.content + b"\n"


def opened(file: BinaryIO) -> BinaryIO:
    """The file's records, whether it is compressed or not."""
    packed = file.read(2) == b"\x1f\x8b"
    file.seek(0)
    return io.BufferedReader(gzip.GzipFile(fileobj=file), 1 << 20) if packed else file


def exactly(file: BinaryIO, size: int) -> bytes:
    data = file.read(size)
    if len(data) != size:
        raise ValueError("an archive ends within a record")
    return data


def arc_records(file: BinaryIO) -> Iterator[Record]:
    """Records of one ARC file, by its version's header lines and their declared lengths."""
    file = opened(file)
    version = None
    while line := file.readline():
        if line in (b"\n", b"\r\n"):
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if version is None:
            if not text.startswith("filedesc://"):
                raise ValueError("an ARC file begins with its version block")
            body = exactly(file, int(text.rpartition(" ")[2]))
            version = int(body.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version} is not known")
            continue
        # The url comes first and may hold blanks, so fields are counted from the end.
        parts = text.rsplit(" ", 4 if version == 1 else 9)
        if len(parts) != (5 if version == 1 else 10):
            raise ValueError(f"not a header line of ARC version {version}: {text[:200]}")
        yield Record(parts[0], parts[1], parts[2], parts[3], exactly(file, int(parts[-1])))


def arc_url(url: str | None, page: int | None) -> str:
    """One word of ASCII, as header lines are split at blanks."""
    return urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page}"


class Output:
    """Files of one task, each moved to its name when it is whole."""

    def __init__(self, folder: str, kind: str):
        self.store, self.folder = pafs.FileSystem.from_uri(folder)
        self.kind, self.done, self.out, self.number = kind, [], None, 0

    def open(self, stem: str) -> None:
        self.name = f"{stem}.{self.kind}.gz"
        self.temporary = f"{self.folder}/{self.name}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.temporary)
        self.held = self.records = 0

    def add(self, record: bytes, counts: bool = True) -> None:
        self.out.write(gzip.compress(record, LEVEL, mtime=0))
        self.held += len(record)
        self.records += counts

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.store.move(self.temporary, f"{self.folder}/{self.name}")
            self.done.append((self.name, self.records))
            self.out = None
            self.number += 1

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.done:
            yield pa.RecordBatch.from_pylist([dict(zip(ARC_FILES.names, x, strict=True)) for x in self.done], ARC_FILES)


def write_arc(pages: DataFrame, folder: str, date: str = "19960101000000", ip: str = "0.0.0.0", id_column: str = "page_id",
              url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Pages as ARC files, version 1 and 2 by turns; one row per file."""
    spark = ship(pages.sparkSession)
    to = uri(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        output, part = Output(to, "arc"), TaskContext.get().partitionId()
        for batch in slices(batches, "html"):
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                version = 1 + (part + output.number) % 2
                if output.out is None:
                    output.open(f"{part:06d}-{output.number:05d}")
                    output.add(version_block(version, output.name, date), counts=False)
                payload = (html or "").encode()
                head = "HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                head += f"X-Page-Id: {page}\r\n" if page is not None else ""
                head += f"Content-Length: {len(payload)}\r\n\r\n"
                output.add(arc_record(version, Record(arc_url(url, page), ip, date, "text/html", head.encode() + payload), output.held, output.name))
                if output.held >= FILE_BYTES:
                    output.close()
        output.close()
        yield from output.batches()

    make_folder(spark, folder)
    rows = columns(pages, page_id=pages[id_column].cast("long"), url=pages[url_column].cast("string"), html=pages[html_column].cast("string"))
    return staged(rows.mapInArrow(write, schema_of(ARC_FILES)), "arc")


def read_arc(files: DataFrame, folder: str) -> DataFrame:
    """One row per record of the ARC files, without the content."""
    ship(files.sparkSession)
    at = uri(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = pafs.FileSystem.from_uri(at)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                out: dict[str, list] = {f.name: [] for f in ARC_RECORDS}
                with store.open_input_file(f"{top}/{name}") as file:
                    for number, record in enumerate(arc_records(file)):
                        fields, _, payload = http(record.content)
                        row = (name, number, page_id(fields), len(payload), hashlib.sha256(payload).hexdigest(), record_id(name, number, record.content))
                        for column, value in zip(out.values(), row, strict=True):
                            column.append(value)
                yield records(out, ARC_RECORDS)

    return files.repartition(max(1, files.count())).mapInArrow(read, schema_of(ARC_RECORDS))


# -- WARC

def record_id(arc_file: str, number: int, content: bytes) -> str:
    """By place and content, so that files of one name from different tables have different ids."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{arc_file}/{number}/{hashlib.sha256(content).hexdigest()}')}>"


def warc_date(date: str) -> str:
    """ISO time of an ARC date of up to 14 digits; what is missing is the first of its kind."""
    digits = re.sub(r"\D", "", date)[:14]
    digits += "19700101000000"[len(digits):]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def warc_record(fields: Iterable[tuple[str, str]], block: bytes) -> bytes:
    digest = "sha256:" + hashlib.sha256(block).hexdigest()
    lines = [f"{k}: {v}" for k, v in [*fields, ("WARC-Block-Digest", digest), ("Content-Length", str(len(block)))]]
    return "\r\n".join(["WARC/1.0", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def converted(record: Record, own: str, refers_to: str | None) -> bytes:
    """The WARC record for an ARC record: a response, a resource if it has no HTTP head, or a revisit of another record."""
    fields, head, payload = http(record.content)
    kind, content = ("response", "application/http; msgtype=response") if head else ("resource", record.mime)
    lines = [("WARC-Type", "revisit" if refers_to else kind), ("WARC-Record-ID", own), ("WARC-Date", warc_date(record.date)),
             ("WARC-Target-URI", record.url), ("WARC-IP-Address", record.ip),
             ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest()),
             ("WARC-Identified-Payload-Type", record.mime), ("Content-Type", content)]
    if refers_to:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", refers_to), (PAYLOAD_LENGTH, str(len(payload)))]
    return warc_record(lines, head if refers_to else record.content)


def convert(arc: DataFrame, arc_folder: str, folder: str, least: int = REVISIT_BYTES) -> DataFrame:
    """Rewrite ARC files as WARC files of the same stem; ``arc`` is what ``read_arc`` gave, written down."""
    spark = ship(arc.sparkSession)
    source, to = uri(arc_folder), uri(folder)
    make_folder(spark, folder)
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "file", "number", "record_id"))
    originals = (arc.filter(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
                 .agg(first.alias("first"), F.count("*").alias("n")).filter("n > 1")
                 .select("payload_digest", "payload_bytes", F.col("first.record_id").alias("original")))
    planned = arc.join(originals, ["payload_digest", "payload_bytes"], "left").select(
        "file", "number", "record_id", F.when(F.col("original") != F.col("record_id"), F.col("original")).alias("refers_to"))

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        name = table.column("file")[0].as_py()
        store, top = pafs.FileSystem.from_uri(source)
        output = Output(to, "warc")
        output.open(name.removesuffix(".arc.gz"))
        info = f"software: plotwise\r\nformat: WARC File Format 1.0\r\nconverted-from: {name}\r\n".encode()
        own = zip(table.column("record_id").to_pylist(), table.column("refers_to").to_pylist(), strict=True)
        with store.open_input_file(f"{top}/{name}") as file:
            for number, (record, (id_, refers_to)) in enumerate(zip(arc_records(file), own, strict=True)):
                if not number:
                    output.add(warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, -1, info)), ("WARC-Date", warc_date(record.date)),
                                            ("WARC-Filename", output.name), ("Content-Type", "application/warc-fields")], info), counts=False)
                output.add(converted(record, id_, refers_to))
        output.close()
        return pa.Table.from_batches(output.batches(), ARC_FILES)

    # A task for each file: plans are small rows, which would otherwise be packed into few tasks.
    files = max(1, arc.select("file").distinct().count())
    return staged(planned.repartition(files, "file").groupBy("file").applyInArrow(write, schema_of(ARC_FILES)), "warc")


def warc_records(file: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record; block digests are verified."""
    file = opened(file)
    while line := file.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {}
        while (line := file.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = exactly(file, int(fields["content-length"]))
        if "sha256:" + hashlib.sha256(block).hexdigest() != fields["warc-block-digest"]:
            raise ValueError("a block differs from its digest")
        yield fields, block


def read_warc(files: DataFrame, folder: str) -> DataFrame:
    """One row per response, resource and revisit of the WARC files; payload digests are verified where there is a payload."""
    ship(files.sparkSession)
    at = uri(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = pafs.FileSystem.from_uri(at)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                out: dict[str, list] = {f.name: [] for f in WARC_RECORDS}
                with store.open_input_file(f"{top}/{name}") as file:
                    for fields, block in warc_records(file):
                        kind = fields["warc-type"]
                        if kind not in ("response", "resource", "revisit"):
                            continue
                        digest = fields["warc-payload-digest"].removeprefix("sha256:")
                        own, _, payload = http(block)
                        if kind != "revisit" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError("a payload differs from its digest")
                        size = int(fields[PAYLOAD_LENGTH.lower()]) if kind == "revisit" else len(payload)
                        row = (fields["warc-record-id"], page_id(own), size, digest, kind, fields.get("warc-refers-to"),
                               fields["warc-target-uri"], fields["warc-date"])
                        for column, value in zip(out.values(), row, strict=True):
                            column.append(value)
                yield records(out, WARC_RECORDS)

    return files.repartition(max(1, files.count())).mapInArrow(read, schema_of(WARC_RECORDS))


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages as ARC, converted to WARC and read back; ``refers_to`` is the page id of the record revisited."""
    top = new_folder(pages.sparkSession, "archives")
    arc = staged(read_arc(write_arc(pages, f"{top}/arc"), f"{top}/arc"), "arc-records")
    read = staged(read_warc(convert(arc, f"{top}/arc", f"{top}/warc"), f"{top}/warc"), "warc-records")
    revisited = read.filter("refers_to_id is not null").select("refers_to_id").distinct()
    named = revisited.join(read.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")), "refers_to_id")
    return read.join(named, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "date", "record_id")
