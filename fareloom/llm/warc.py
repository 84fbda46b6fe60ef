"""WARC archives of pages: one gzip member a record, written and read one record at a time.

Writing: every task writes its pages into archives of its own in the shared folder, rolled over
by size, and returns a row an archive. A retried task writes new files under new names, and
only the rows of the task that counted lead to files, so a lost executor leaves no trace in the
result. Payloads that occur more than once are stored once, as the response of the smallest
page id; the others are revisits that refer to it.

Reading: a sequential reader inflates one gzip member after another in small chunks, cuts the
record by its Content-Length and verifies block and payload digests. Damage raises WarcError.

Nulls: a null html is the empty payload; a null url is left out of the headers; a page without
an id refers to others but is never referred to, unless no copy has an id (then all are
responses). Repeated rows of the page that responds are all responses. Empty tables give no
archives and no rows. Further columns of the input are not archived.
"""

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.sources.sinks import new_folder, stage

# Fixed values of the format.
VERSION = b"WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD_DATE = "2025-01-01T00:00:00Z"

CHUNK = 1 << 16
MOST_HEADER = 1 << 20


class WarcError(ValueError):
    """An archive that does not hold what its headers say."""


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    digits = name.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def write_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response, or a revisit if it refers to another page, as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": RECORD_DATE,
        "Content-Type": "application/http;msgtype=response",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        # Characters that would end a header line, and spaces, are percent-encoded.
        headers["WARC-Target-URI"] = quote(url, safe="%/:?#[]@!$&'()*+,;=~-._")
    if refers_to is not None:
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(refers_to)}
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers.items()), b"", b""]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(b"\r\n".join(lines) + block + b"\r\n\r\n") + deflate.flush()


def _headers(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"not a header: {line[:80]!r}")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def members(source: BinaryIO) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as the inflated chunks of it, read incrementally."""
    rest = b""

    def inflate() -> Iterator[bytes]:
        nonlocal rest
        z = zlib.decompressobj(31)
        data = rest
        while True:
            while data or z.unconsumed_tail:
                try:
                    out = z.decompress(z.unconsumed_tail or data, CHUNK)
                except zlib.error as error:
                    raise WarcError(f"damaged gzip member: {error}") from error
                data = b""
                if out:
                    yield out
                if z.eof:
                    rest = z.unused_data
                    return
            data = source.read(CHUNK)
            if not data:
                raise WarcError("archive ends inside a record")

    while True:
        rest = rest or source.read(CHUNK)
        if not rest:
            return
        member = inflate()
        yield member
        for _ in member:  # a reader that stopped early must not lose its place
            pass


def read_records(source: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, its framing and block digest verified."""
    for member in members(source):
        held = bytearray()
        for chunk in member:
            held += chunk
            if (end := held.find(b"\r\n\r\n")) >= 0:
                break
            if len(held) > MOST_HEADER:
                raise WarcError("headers do not end")
        else:
            raise WarcError("record without headers")
        version, *lines = bytes(held[:end]).split(b"\r\n")
        if version != VERSION:
            raise WarcError(f"not a record: {version[:40]!r}")
        headers = _headers(lines)
        length = int(headers.get("content-length", "-1"))
        if length < 0:
            raise WarcError("record without Content-Length")
        del held[: end + 4]
        for chunk in member:
            held += chunk
            if len(held) > length + 4:
                raise WarcError("record is longer than its Content-Length")
        if held[length:] != b"\r\n\r\n":
            raise WarcError("record does not end where its Content-Length says")
        block = bytes(held[:length])
        _verify(headers.get("warc-block-digest"), block)
        yield headers, block


def _verify(stated: str | None, data: bytes) -> None:
    if stated is not None and stated != f"sha256:{hashlib.sha256(data).hexdigest()}":
        raise WarcError("digest does not match")


def read_pages(source: BinaryIO) -> Iterator[dict]:
    """Page records of an archive: ids, url, payload (null for a revisit), full size and digest."""
    for headers, block in read_records(source):
        kind = headers.get("warc-type")
        if kind not in ("response", "revisit"):
            continue
        head, gap, payload = block.partition(b"\r\n\r\n")
        if not gap:
            raise WarcError("block without HTTP headers")
        size = int(_headers(head.split(b"\r\n")[1:]).get("content-length", "-1"))
        if kind == "response":
            _verify(headers.get("warc-payload-digest"), payload)
            if size != len(payload):
                raise WarcError("payload is not as long as stated")
        yield {
            "page_id": page_of(headers["warc-record-id"]),
            "url": headers.get("warc-target-uri"),
            "payload": payload if kind == "response" else None,
            "payload_bytes": size,
            "payload_digest": headers["warc-payload-digest"].removeprefix("sha256:"),
            "record_type": kind,
            "refers_to": page_of(headers["warc-refers-to"]) if kind == "revisit" else None,
        }


def mark_revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """page_id, url, payload, digest and the page each refers to, null for responses.

    Copies are found on digests alone; a payload that occurs once meets no other row.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    copied = (
        rows.where(F.length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("page_id").alias("first_page"))
        .where("copies > 1 AND first_page IS NOT NULL")
        .drop("copies")
    )
    return rows.join(copied, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_page")), F.col("first_page")).alias("refers_to"),
    )


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The filesystem of a folder given as a URI or as a plain path, and the path on it."""
    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


def write_archives(pages: DataFrame, folder: str, most_bytes: int = 256 * 1024**2) -> DataFrame:
    """Archive ``pages`` below ``folder``; returns the stored list of archives: path, n_records."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(folder)
        store.create_dir(base, recursive=True)
        out, path, written, records = None, "", 0, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, written, records = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)
                member = write_record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                out.write(member)
                written, records = written + len(member), records + 1
                if written >= most_bytes:
                    out.close()
                    done.append((path, records))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records))
        if done:
            yield pa.RecordBatch.from_pydict({"path": [p for p, _ in done], "n_records": [n for _, n in done]})

    archives = mark_revisits(pages).mapInArrow(run, "path string, n_records long")
    return stage(archives, "archives")


def read_archives(spark: SparkSession, archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Every page record of the listed archives; an archive is read by one task, front to back."""
    names = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, " \
        "record_type string, refers_to long"
    if not payloads:
        names = names.replace("payload binary, ", "")
    types = pa.schema(
        [
            (n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kind])
            for n, kind in (x.split() for x in names.split(", "))
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path, compression=None, buffer_size=CHUNK) as source:
                    rows, size = [], 0
                    for page in read_pages(source):
                        if not payloads:
                            del page["payload"]
                        rows.append(page)
                        size += page["payload_bytes"] if payloads else 200
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, types)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, types)

    wanted = max(1, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return archives.select("path").repartition(wanted, "path").mapInArrow(run, names)


def archive_and_read(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder and read the archives back, without payloads."""
    folder = new_folder(spark, "warc")
    return read_archives(spark, write_archives(pages, folder), folder, payloads=False)
