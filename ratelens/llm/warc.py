"""ARC archives of both versions, their conversion to WARC, and reading WARC back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm.common import slices

#: The URL-record definitions of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Names that WARC 1.1 gives.
WARC_VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:archive-record")
CAPTURED = "20240101000000"
_BATCH_BYTES = 4 << 20
_PARSED = (
    "record_id string, page_id bigint, url string, ip string, captured string, mime string, payload_digest string, "
    "payload_bytes bigint, head binary, payload binary, block_digest string, head_digest string"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _url(url: str | None) -> str:
    """A URL without the characters that a header line can't hold; ``-`` for none."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else "-"


def arc_line(version: int, url: str, mime: str, size: int, offset: int, name: str) -> str:
    """Header line of an ARC record, with the fields of the version."""
    if version == 1:
        return f"{url} 0.0.0.0 {CAPTURED} {mime} {size}\n"
    return f"{url} 0.0.0.0 {CAPTURED} {mime} 200 - - {offset} {name} {size}\n"


def version_block(version: int, name: str) -> str:
    """First record of an ARC file: it says which fields the header lines after it have."""
    body = f"{version} 0 archive\n{ARC_FIELDS[version]}\n"
    return arc_line(version, f"filedesc://{name}", "text/plain", len(body), 0, name) + body


def write_arc(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> None:
    """An ARC record per row, in gzip files of a task's rows; even tasks write version 1 and odd ones version 2.

    The network document is an HTTP response whose headers carry the id and the payload's length. A null text
    is an empty payload, a null URL ``-``, a null id no header. Spark's text writer commits the files, so a lost
    task leaves no part of one.
    """
    source = df.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version, name = 1 + part % 2, f"part-{part:05d}.arc"
        first = version_block(version, name)
        offset = len(first) + 1
        yield pa.record_batch({"value": [first]})
        for batch in (piece for whole in batches for piece in slices(whole)):
            out = []
            for page, url, text in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "text"))):
                size = len(text.encode("utf-8", "surrogatepass"))
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n"
                if page is not None:
                    head += f"X-Page-Id: {page}\r\n"
                head += "\r\n"
                line = arc_line(version, _url(url), "text/html", len(head) + size, offset, name)
                out.append(line + head + text)
                offset += len(line.encode()) + len(head) + size + 1
            yield pa.record_batch({"value": pa.array(out, pa.string())})

    source.mapInArrow(run, "value string").write.option("compression", "gzip").option("lineSep", "\n").text(path)


def _header(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"^" + re.escape(name) + rb":[ \t]*(.*?)[ \t]*\r?$", head, re.MULTILINE | re.IGNORECASE)
    return found.group(1).decode("utf-8", "replace") if found else None


def _split_http(block: bytes) -> tuple[bytes, bytes]:
    at = block.find(b"\r\n\r\n")
    return (block[: at + 4], block[at + 4 :]) if at >= 0 else (b"", block)


def arc_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of each record of an ARC stream, version blocks left out.

    Each version block sets the fields of the lines that follow it. Contents are taken by the declared length,
    whatever they hold. A line with too few fields, or a file cut short, is an error.
    """
    fields: list[str] = []
    while line := stream.readline():
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if not text:
            continue
        size = int(text.rsplit(" ", 1)[-1])
        content = stream.read(size)
        if len(content) != size:
            raise ValueError(f"ARC record of {size} bytes ends after {len(content)}")
        if text.startswith("filedesc://"):
            lines = content.decode("ascii", "replace").split("\n")
            version = int(lines[0].split(" ")[0])
            fields = (lines[1] if len(lines) > 1 and lines[1] else ARC_FIELDS[version]).split(" ")
            continue
        values = text.rsplit(" ", len(fields) - 1)
        if not fields or len(values) != len(fields):
            raise ValueError("ARC header line without a version block, or with too few fields")
        yield dict(zip(fields, values)), content


def iso_date(stamp: str) -> str:
    """The 14 digits of an ARC date as a WARC date."""
    stamp = stamp.ljust(14, "0")
    return f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z"


def read_arc(spark: SparkSession, path: str, payload: bool) -> DataFrame:
    """Records of ARC files with what WARC needs synthesised; without ``payload`` the contents stay behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _PARSED.split(", ")]
        kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "head": pa.binary(), "payload": pa.binary()}
        for batch in batches:
            for scalar in batch.column("content"):
                rows, held = [], 0
                stream = gzip.GzipFile(fileobj=pa.BufferReader(scalar.as_buffer()))
                for fields, block in arc_records(io.BufferedReader(stream, 1 << 16)):
                    head, body = _split_http(block)
                    page = _header(head, b"X-Page-Id")
                    digest = base32_sha1(body)
                    captured = iso_date(fields["Archive-date"])
                    record = uuid.uuid5(NAMESPACE, f"{fields['URL']} {captured} {digest} {page}")
                    rows.append((
                        f"<urn:uuid:{record}>", int(page) if page else None, fields["URL"], fields["IP-address"], captured,
                        fields["Content-type"], digest, len(body), head if payload else None, body if payload else None,
                        base32_sha1(block) if payload else None, base32_sha1(head) if payload else None,
                    ))
                    held += len(block) if payload else 64
                    if held > _BATCH_BYTES:
                        yield pa.record_batch([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows))], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows))], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(run, _PARSED)


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = 0) -> None:
    """WARC files of the records in ARC files, equal payloads of at least ``least`` bytes archived once.

    The record with the largest id keeps the payload; the others refer to it as revisits. Digests meet first,
    without payloads, and combine before they are shuffled; payloads then meet only the small table of revisits,
    by record, so that a payload of which there are many copies is no hot key. Ids of records are name-based, so
    a task that runs again writes the same.
    """
    light = read_arc(spark, arc_path, payload=False).select("record_id", "page_id", "url", "captured", "payload_digest", "payload_bytes")
    big = light.filter(F.col("payload_bytes") >= least)
    kept = big.groupBy("payload_digest").agg(
        F.max(F.struct("page_id", "record_id", "url", "captured")).alias("first")
    )
    pairs = big.select("record_id", "page_id", "payload_digest").join(kept, "payload_digest")
    later = F.coalesce(F.col("page_id") < F.col("first.page_id"), F.col("first.page_id").isNotNull())
    revisits = pairs.filter(later).select(F.col("record_id").alias("revisit_id"), "first").distinct()
    full = read_arc(spark, arc_path, payload=True)
    joined = full.join(revisits, full["record_id"] == revisits["revisit_id"], "left")
    again = F.col("revisit_id").isNotNull()
    block = F.when(again, F.col("head")).otherwise(F.concat("head", "payload"))

    def line(name: str, value) -> F.Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    referring = F.concat(
        line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", F.col("first.record_id")),
        line("WARC-Refers-To-Target-URI", F.col("first.url")), line("WARC-Refers-To-Date", F.col("first.captured")),
        line("X-Refers-To-Page", F.col("first.page_id").cast("string")),
    )
    header = F.concat(
        F.lit(WARC_VERSION.decode() + "\r\n"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.col("captured")), line("WARC-Target-URI", F.col("url")),
        line("WARC-IP-Address", F.col("ip")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.when(again, F.col("head_digest")).otherwise(F.col("block_digest")))),
        F.when(again, referring).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.length(block).cast("string")), F.lit("\r\n"),
    )
    # A cast from binary to string keeps the bytes as they are, and so does the text writer.
    records = joined.select(F.concat(F.encode(header, "utf-8"), block).cast("string").alias("value"))
    records.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(warc_path)


def warc_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a WARC stream, by declared lengths."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"WARC record of {size} bytes ends after {len(block)}")
        yield fields, block


_READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, record_id string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits of WARC files. A response's payload must match its digest, else it is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _READ.split(", ")]
        numbers = {"page_id", "payload_bytes", "refers_to"}

        def table(rows):
            return pa.record_batch(
                [pa.array(c, pa.int64() if n in numbers else pa.string()) for n, c in zip(names, zip(*rows))], names=names
            )

        for batch in batches:
            for scalar in batch.column("content"):
                rows = []
                stream = gzip.GzipFile(fileobj=pa.BufferReader(scalar.as_buffer()))
                for fields, block in warc_records(io.BufferedReader(stream, 1 << 16)):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    head, body = _split_http(block)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and base32_sha1(body) != digest:
                        raise ValueError(f"payload of {fields['warc-record-id']} doesn't match its digest")
                    page, refers = _header(head, b"X-Page-Id"), fields.get("x-refers-to-page")
                    size = len(body) if kind == "response" else int(_header(head, b"Content-Length") or 0)
                    url = fields["warc-target-uri"]
                    rows.append((
                        int(page) if page else None, size, digest, kind, int(refers) if refers else None,
                        None if url == "-" else url, fields["warc-record-id"],
                    ))
                    if len(rows) == 10_000:
                        yield table(rows)
                        rows = []
                if rows:
                    yield table(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(run, _READ)


def archive(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", least: int = 0) -> DataFrame:
    """Rows of ``df`` written as ARC, converted to WARC, both under ``folder``, and read back from WARC.

    One row for each row of ``df``, repeated rows too: those with the largest id of their payload are responses.
    An empty table gives empty archives and an empty result.
    """
    spark = df.sparkSession
    write_arc(df, f"{folder}/arc", id_col, url_col, text_col)
    convert(spark, f"{folder}/arc", f"{folder}/warc", least)
    return read_warc(spark, f"{folder}/warc")
