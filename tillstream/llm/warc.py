"""Legacy archives (ARC versions 1 and 2) to WARC.

`write_arc` puts pages into ARC files. `read_arc` parses them: the version block names the fields of the URL
lines (5 in version 1, 10 in version 2), and each line's declared length says where its content ends.
`convert` synthesises WARC fields from them: a record id from archive name and offset, an ISO timestamp,
record type and SHA-256 payload digest. `write_warc` writes records; `read_warc` reads them back, checking
each stored payload against its digest.

Files are written by Spark, one file of bounded size per row (a page longer than that has a file of its own),
gzip-compressed, so a lost task is repeated like any other. Of equal payloads of at least `least_bytes`, the
smallest page id is the response; groups are summed in each task before the shuffle, and the join back to
records splits a heavy digest (skew join).

Defined cases: null html is an empty payload; a null or blank URL becomes `urn:page:<id>`; white space and
controls in URLs are percent-encoded; of rows that repeat a page id and its payload, the first by record id
is the response and the others revisit it; null page ids rank last; an empty table gives an empty result;
columns of any other name are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.base import filled
from tillstream.session import workspace

FILE_BYTES = 8 << 20
LEAST_BYTES = 100
CAPTURED = "20240101000000"  # pages carry no date

# The first lines of an ARC version block and the names of its URL-line fields.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORD = (
    "record_id string, target_uri string, ip string, date string, content_type string, page_id bigint, "
    "head string, payload binary, payload_digest string"
)
_READ = "record_id string, page_id bigint, record_type string, payload_bytes bigint, payload_digest string, refers_to_id string"


def _arc_version_block(version: str, name: str) -> bytes:
    fields = ARC_FIELDS[version].encode()
    body = version.encode() + b" 0 archive\n" + fields + b"\n"
    return _arc_line(version, f"filedesc://{name}", "text/plain", len(body), name, 0) + b"\n" + body


def _arc_line(version: str, url: str, kind: str, length: int, name: str, offset: int) -> bytes:
    if version == "1":
        parts = [url, "0.0.0.0", CAPTURED, kind, str(length)]
    else:
        parts = [url, "0.0.0.0", CAPTURED, kind, "200", "-", "-", str(offset), name, str(length)]
    return " ".join(parts).encode()


def _clean_url(url: str | None, page_id) -> str:
    if not url or not url.strip():
        return f"urn:page:{page_id}"
    return re.sub(r"[\x00-\x20\x7f]", lambda found: f"%{ord(found[0]):02X}", url)


def _http_head(page_id, size: int) -> bytes:
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{own}Content-Length: {size}\r\n\r\n".encode()


def _number(value):
    return None if pd.isna(value) else int(value)


def write_arc(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> None:
    """Pages as ARC files, versions 1 and 2 in turn."""

    def build(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, count = TaskContext.get().partitionId(), 0
        blob, name, version = bytearray(), "", ""
        for part in parts:
            for page_id, url, html in zip(part["page_id"], part["url"], part["html"]):
                page_id = _number(page_id)
                payload = html.encode()
                content = _http_head(page_id, len(payload)) + payload
                if blob and len(blob) + len(content) > file_bytes:
                    yield pd.DataFrame({"value": [blob.decode()]})
                    blob = bytearray()
                if not blob:
                    version, count = str(1 + (task + count) % 2), count + 1
                    name = f"pages-{task:06d}-{count:06d}.arc"
                    blob += _arc_version_block(version, name)
                blob += b"\n" + _arc_line(version, _clean_url(url, page_id), "text/html", len(content), name, len(blob) + 1)
                blob += b"\n" + content
        if blob:
            yield pd.DataFrame({"value": [blob.decode()]})

    page_id, url = F.col("page_id").cast("bigint"), F.col("url").cast("string")
    rows = pages.select(page_id.alias("page_id"), url.alias("url"), filled(F.col("html")).alias("html"))
    _write_files(rows.mapInPandas(build, "value string"), folder, "\n")


def _write_files(contents: DataFrame, folder: str, end: str) -> None:
    """One gzip file for each row."""
    writer = contents.write.option("maxRecordsPerFile", 1).option("lineSep", end).option("compression", "gzip")
    writer.option("zlib.compress.level", "BEST_SPEED").text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")


def parse_arc(data: bytes) -> Iterator[tuple[str, int, dict, bytes]]:
    """(archive name, offset, fields of the URL line, content) of each record, the version block left out."""
    name, at, fields = "", 0, None
    while at < len(data):
        if data[at : at + 1] == b"\n":  # the separator after a record
            at += 1
            continue
        end = data.index(b"\n", at)
        values = data[at:end].decode("utf-8", "replace").split(" ")
        size = int(values[-1])
        content = data[end + 1 : end + 1 + size]
        if len(content) < size:
            raise ValueError(f"record at {at} declares {size} bytes and has {len(content)}")
        if values[0].startswith("filedesc://"):
            name = values[0].removeprefix("filedesc://")
            lines = content.decode("utf-8", "replace").split("\n")
            version = lines[0].split(" ")[0]
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version!r}")
            fields = lines[1].split(" ")
        else:
            if fields is None or len(values) != len(fields):
                raise ValueError(f"record at {at} has {len(values)} fields")
            yield name, at, dict(zip(fields, values)), content
        at = end + 1 + size


def _header(head: str, name: str) -> str | None:
    found = re.search(rf"(?im)^{name}:[ \t]*(.*?)\r?$", head)
    return found[1] if found else None


def read_arc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of ARC files with their WARC fields."""

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for content in part["content"]:
                rows = []
                for name, at, line, block in parse_arc(gzip.decompress(content)):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    head = head.decode()
                    page, when = _header(head, "X-Page-Id"), line["Archive-date"]
                    rows.append(
                        (
                            f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{at}')}>", line["URL"], line["IP-address"],
                            f"{when[:4]}-{when[4:6]}-{when[6:8]}T{when[8:10]}:{when[10:12]}:{when[12:14]}Z",
                            line["Content-type"], page and int(page), head, payload, hashlib.sha256(payload).hexdigest(),
                        )
                    )
                names = [field.split()[0] for field in _RECORD.split(", ")]
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})

    return _files(spark, folder).mapInPandas(parse, _RECORD)


def convert(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Records with the id of the record they revisit, or null for responses."""
    size = F.octet_length("payload")
    page = F.coalesce("page_id", F.lit(2**63 - 1))
    large = records.where(size >= least_bytes)
    candidate = F.struct(page.alias("page"), "record_id", "target_uri", "date")
    first = large.groupBy("payload_digest").agg(F.min(candidate).alias("first"))
    joined = records.withColumn("large_digest", F.when(size >= least_bytes, F.col("payload_digest"))).join(
        first.withColumnRenamed("payload_digest", "first_digest"), F.col("large_digest") == F.col("first_digest"), "left"
    )
    other = F.col("first.record_id") != F.col("record_id")
    return joined.select(
        *records.columns, F.when(other, F.col("first.record_id")).alias("refers_to_id"),
        F.when(other, F.col("first.target_uri")).alias("refers_to_uri"), F.when(other, F.col("first.date")).alias("refers_to_date"),
    )


def _warc_record(row) -> bytes:
    revisit = isinstance(row.refers_to_id, str)
    block = row.head.encode() + b"\r\n\r\n" + (b"" if revisit else row.payload)
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {row.record_id}",
        f"WARC-Date: {row.date}", f"WARC-Target-URI: {row.target_uri}", f"WARC-IP-Address: {row.ip}",
        f"WARC-Payload-Digest: sha256:{row.payload_digest}", "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines += [
            f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {row.refers_to_id}",
            f"WARC-Refers-To-Target-URI: {row.refers_to_uri}", f"WARC-Refers-To-Date: {row.refers_to_date}",
        ]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block


def write_warc(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> None:
    def build(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blob = bytearray()
        for part in parts:
            for row in part.itertuples(index=False):
                record = _warc_record(row)
                if blob and len(blob) + len(record) > file_bytes:
                    yield pd.DataFrame({"value": [blob.decode()]})
                    blob = bytearray()
                if blob:
                    blob += b"\r\n\r\n"
                blob += record
        if blob:
            yield pd.DataFrame({"value": [blob.decode()]})

    _write_files(records.mapInPandas(build, "value string"), folder, "\r\n\r\n")


def parse_warc(data: bytes) -> Iterator[tuple[str, bytes]]:
    """(header, block) of each record, by declared lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode()
        if not head.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        size = int(_header(head, "Content-Length"))
        yield head, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """record_id, page_id, record_type, payload size and digest, refers_to_id of each record."""

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for content in part["content"]:
                rows = []
                for head, block in parse_warc(gzip.decompress(content)):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    http = http.decode()
                    kind, digest = _header(head, "WARC-Type"), _header(head, "WARC-Payload-Digest").removeprefix("sha256:")
                    size, page = int(_header(http, "Content-Length")), _header(http, "X-Page-Id")
                    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"payload of {_header(head, 'WARC-Record-ID')} does not fit its digest")
                    rows.append(
                        (_header(head, "WARC-Record-ID"), page and int(page), kind, size, digest, _header(head, "WARC-Refers-To"))
                    )
                names = [field.split()[0] for field in _READ.split(", ")]
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})

    return _files(spark, folder).mapInPandas(parse, _READ)


def archived(pages: DataFrame, file_bytes: int = FILE_BYTES, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Pages through ARC files and WARC files; what the WARC files say of each page."""
    spark = pages.sparkSession
    root = workspace(spark, "archives")
    write_arc(pages, f"{root}/arc", file_bytes)
    write_warc(convert(read_arc(spark, f"{root}/arc"), least_bytes), f"{root}/warc", file_bytes)
    records = read_warc(spark, f"{root}/warc")
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    )
    return records.join(responses, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"
    )
