"""WARC archives: one gzip member per record, written from a table of pages and read back sequentially.

Writing: rows whose payload digest is equal are one response, that of the largest page_id, and revisits of it (profile identical
payload digest, without a body). Only digests and ids meet in the aggregation; pages join its result on the digest.
Every task writes archives of about ``FILE_BYTES`` under a name of its own and reports them in a manifest that is stored; a
repeated task leaves files that no manifest names. The folder must be one that executors share.

Reading: archives are streamed through zlib one member at a time, a record is framed by its Content-Length, and its block and payload
digests are verified. Truncated members, wrong lengths and wrong digests raise ``WarcError``. A task holds one record at a time.

Payloads are UTF-8; a null page is an empty payload. Payloads below ``least`` bytes are always responses. A row without a page_id is
a response only if no row of its payload has one; repeated rows with the largest page_id are all responses. Input columns with other names are ignored.
"""
from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from loupeline.llm import common
from loupeline.session import scratch, written

FILE_BYTES = 64 << 20
READ_BYTES = 1 << 16
EPOCH = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload binary"


class WarcError(ValueError):
    """An archive that does not follow its own framing or digests."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (b"" if revisit else b"Content-Length: %d\r\n" % len(payload)) + b"\r\n"
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", EPOCH)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}")]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in head) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def members(stream) -> Iterator[bytes]:
    """Decompressed gzip members of a stream, read in small pieces."""
    unpack, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        piece = rest or stream.read(READ_BYTES)
        rest = b""
        if not piece:
            if parts or unpack.unconsumed_tail:
                raise WarcError("the last member is cut off")
            return
        try:
            parts.append(unpack.decompress(piece))
        except zlib.error as error:
            raise WarcError(f"not a gzip member: {error}") from error
        if unpack.eof:
            yield b"".join(parts)
            rest, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []


def parse(member: bytes) -> dict:
    """Named fields and block of a record; checks its framing and digests."""
    head, mark, rest = member.partition(b"\r\n\r\n")
    lines = head.decode(errors="replace").split("\r\n")
    if not mark or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError("no WARC header")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    if not fields.get("Content-Length", "").isdigit():
        raise WarcError("no content length")
    size = int(fields["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise WarcError("the content length is wrong")
    if fields.get("WARC-Block-Digest") != f"sha1:{sha1_base32(block)}":
        raise WarcError("the block digest is wrong")
    for name in ("WARC-Type", "WARC-Payload-Digest", "WARC-Record-ID"):
        if name not in fields:
            raise WarcError(f"no {name}")
    http, mark, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not mark or revisit and payload or not revisit and sha1_base32(payload) != digest:
        raise WarcError("the payload digest is wrong")

    def page(name: str) -> int | None:
        value = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        if value in ("", "None"):
            return None
        try:
            return int(value)
        except ValueError:
            raise WarcError(f"{name} names no page") from None

    if revisit and page("WARC-Refers-To") is None:
        raise WarcError("a revisit refers to no record")
    return {"page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
            "refers_to": page("WARC-Refers-To"), "payload_digest": digest, "payload": None if revisit else payload}


def _file_system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``page_id, url, html`` of ``pages`` and returns the stored manifest: ``path, records, bytes``."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    digest = F.sha1("payload")
    first = rows.where(F.length("payload") >= least).groupBy(digest.alias("digest")).agg(F.max("page_id").alias("newest"))
    rows = rows.withColumn("digest", digest).join(first, "digest", "left")
    rows = rows.withColumn("revisit", F.coalesce((F.length("payload") >= least) & ~F.col("page_id").eqNullSafe(F.col("newest")), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        system.create_dir(base, recursive=True)
        out, path, made, size = None, "", 0, 0
        for batch in batches:
            for row in _rows(batch):
                if out is None:
                    path, made, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{base}/{path}", compression=None)
                packed = record(row["page_id"], row["url"], row["payload"], base64.b32encode(bytes.fromhex(row["digest"])).decode(), row["newest"], row["revisit"])
                out.write(packed)
                made, size = made + 1, size + len(packed)
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield _manifest(f"{folder}/{path}", made, size)
        if out is not None:
            out.close()
            yield _manifest(f"{folder}/{path}", made, size)

    return written(common.bounded(rows).mapInArrow(run, "path string, records bigint, bytes bigint"), "warc-manifest")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(0, batch.num_rows, 64):
        yield from batch.slice(at, 64).to_pylist()


def _manifest(path: str, records: int, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Every record of the archives named in ``manifest`` (column path): ``page_id, url, record_type, refers_to, payload_digest, payload``;
    revisits have no payload. Archives are spread evenly over the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, name = _file_system(path)
                held, size = [], 0
                with system.open_input_stream(name, compression=None) as stream:
                    for member in members(stream):
                        held.append(parse(member))
                        size += len(member)
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("path").repartition(tasks).mapInArrow(run, RECORDS)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with ``payload_bytes`` of the full payload; a revisit's is that of the response it refers to.

    A revisit whose response is not among the records, or has another digest, is an error: its payload is lost.
    """
    sized = written(records.select("page_id", "url", "record_type", "refers_to", "payload_digest", F.length("payload").cast("bigint").alias("_own")), "warc-records")
    whole = sized.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("_own").alias("_full"))
    lost = F.raise_error(F.concat(F.lit("the response of a revisit is lost: page "), F.col("refers_to").cast("string")))
    size = F.when(F.col("record_type") != "revisit", F.col("_own")).when(F.col("_full").isNull(), lost.cast("bigint")).otherwise(F.col("_full"))
    return (sized.join(written(whole, "warc-sizes"), ["refers_to", "payload_digest"], "left")
            .select("page_id", "url", "record_type", "refers_to", "payload_digest", size.alias("payload_bytes")))
