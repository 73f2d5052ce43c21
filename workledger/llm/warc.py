"""WARC archives: one gzip member per record, read back in sequence.

Every task writes one archive into a shared folder under a name of its own and
reports it; only archives that a finished task has reported are read, so a task
that is lost and run again leaves a file that nothing refers to. The reader goes
through an archive from its start: members are inflated piece by piece, the block
is framed by its content length, and block and payload digests are verified.

A page whose payload equals that of a page with a larger id is written as a
revisit of it, without payload.

Defined cases: null pages are empty payloads, null urls an empty target; pages
without id count as smaller than all others; rows that repeat the largest id of
their payload are all responses; pages of any length are one record each; columns
besides id, address and content are not carried; an empty table gives no archive and no records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from workledger.llm.common import portable
from workledger.session import fresh_folder, materialize

# Names and forms of the archive format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"

LEAST_BYTES = 0
CHUNK = 1 << 16

ARCHIVES = "path string, records long, bytes long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, "
    "payload binary, block_ok boolean, payload_ok boolean, path string, offset long"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- one record ---------------------------------------------------------------


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_of(urn: str | None) -> int | None:
    name = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name and name != "none" else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """A whole record, not compressed; a revisit has the response's head and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if is_revisit else head + payload
    fields = {
        "WARC-Type": "revisit" if is_revisit else "response",
        "WARC-Record-ID": _urn(page_id),
        "WARC-Date": NO_DATE,
        "WARC-Target-URI": quote(url or "", safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if is_revisit:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _urn(refers_to)}
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def members(stream: BinaryIO) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member, inflated piece by piece."""
    offset = at = 0
    inflate, parts, waiting = zlib.decompressobj(wbits=31), [], b""
    while True:
        data = waiting or stream.read(CHUNK)
        if not data:
            if parts or at > offset:
                raise ValueError(f"the member at {offset} is cut off")
            return
        parts.append(inflate.decompress(data))
        waiting = inflate.unused_data
        at += len(data) - len(waiting)
        if inflate.eof:
            yield offset, b"".join(parts)
            offset, inflate, parts = at, zlib.decompressobj(wbits=31), []


def _fields(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def parse(content: bytes) -> dict:
    """Fields, payload and verified digests of one record."""
    head, found, rest = content.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not found or not version.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    fields = _fields(lines)
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) < length or rest[length:] != b"\r\n\r\n":
        raise ValueError("the block does not end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    is_revisit = fields["warc-type"] == "revisit"
    said = fields["warc-payload-digest"].partition(":")[2]
    return {
        "page_id": _page_of(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "record_type": fields["warc-type"],
        "refers_to": _page_of(fields.get("warc-refers-to")),
        "payload_digest": said,
        "payload_bytes": int(_fields(http.partition(b"\r\n")[2])["content-length"]) if is_revisit else len(payload),
        "payload": None if is_revisit else payload,
        "block_ok": fields["warc-block-digest"].partition(":")[2] == digest(block),
        "payload_ok": None if is_revisit else said == digest(payload),
    }


# --- tables -------------------------------------------------------------------


def with_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Add ``is_revisit`` and ``refers_to``: the largest page id among equal payloads of at least ``least_bytes``."""
    pages = pages.withColumn("sha", F.sha1(F.coalesce("html", F.lit(""))))
    long_enough = F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes
    same = pages.filter(long_enough).groupBy("sha").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
    # Written first, so that the join has an exchange of its own on both sides and can split a frequent payload.
    largest = materialize(same.filter("n > 1").drop("n"), "largest")
    joined = pages.join(largest, "sha", "left")
    is_revisit = F.coalesce(F.col("largest") > F.col("page_id"), F.col("largest").isNotNull() & F.col("page_id").isNull())
    is_revisit = is_revisit & long_enough
    return joined.withColumn("is_revisit", F.coalesce(is_revisit, F.lit(False))).withColumn(
        "refers_to", F.when(F.col("is_revisit"), F.col("largest"))
    )


def _open(path: str, write: bool):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    return system.open_output_stream(name, compression=None) if write else system.open_input_stream(name, compression=None)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per page (``page_id, url, html, is_revisit, refers_to``); returns the archives written."""
    columns = ["page_id", "url", "html", "is_revisit", "refers_to"]

    def run(batches):
        import uuid

        # Another name for every attempt: what a lost attempt leaves is never mistaken for an archive.
        path, stream, count, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, html, is_revisit, refers_to = (batch.column(k)[i].as_py() for k in range(len(columns)))
                deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                content = record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers_to, is_revisit)
                packed = deflate.compress(content) + deflate.flush()
                stream = stream or _open(path, write=True)
                stream.write(packed)
                count, size = count + 1, size + len(packed)
        if stream:
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count]), pa.array([size])], names=["path", "records", "bytes"])

    return materialize(pages.select(*columns).mapInArrow(portable(run), ARCHIVES), "archives")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives named in the column ``path``; ``payloads`` False leaves the payload column null."""

    def run(batches):
        kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORDS.split(", ")])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with _open(path, write=False) as stream:
                    for offset, content in members(stream):
                        row = parse(content) | {"path": path, "offset": offset}
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        size += len(content) if payloads else 256
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    # One archive per task: they are far fewer than records and each is read in sequence.
    paths = archives.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(portable(run), RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Write all pages as archives into the shared folder and read the records back."""
    folder = fresh_folder(spark, "warc")
    make_folder(spark, folder)
    marked = with_revisits(pages.select("page_id", "url", "html"))
    return read_archives(write_archives(marked, folder), payloads)


def make_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


def verified(records: DataFrame) -> Column:
    """Whether every digest that can be checked holds."""
    return F.coalesce(F.col("block_ok") & F.coalesce("payload_ok", F.lit(True)), F.lit(False))
