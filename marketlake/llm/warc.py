"""WARC archives, index first: a row of offset, length, URL and digest for each record, read back by byte ranges.

Writing. A payload is told by its SHA-1 and length. Of the rows with one payload
the one of the largest key (null keys smallest; then the largest URL, then any)
becomes a ``response`` record, the others ``revisit`` records that name it. The
payloads are combined by digest before they are shuffled, so copies travel once
a task; revisits are made of narrow rows only. Each task streams its records to
archive files of its own (``<uuid>.warc.gz``, one gzip member a record) and gives
an index row for each record. The index table is what commits them: a task that
is run again writes other files, and files that no index row names are ignored.

Reading. Index rows are chosen like any DataFrame, dealt by file and ``SPAN``
bytes of it, sorted by offset, and ranges with gaps of at most ``GAP`` bytes are
fetched by one read of at most ``SPAN`` bytes (or one record, if that is longer).
Each record is unpacked, parsed by its lengths, and its payload checked against
the digest; a record that doesn't fit its index row or digest fails the job.

A null payload is empty; a null URL has no target line; URLs are written with
their control, blank and non-ASCII bytes percent-encoded (the index keeps them as
they are). Repeated rows are records of their own. Empty tables give no archive.
Archives lie in the shared folder that Spark checkpoints to, or a folder of the
caller's on storage that pyarrow opens (local or mounted path, s3, hdfs, gs).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, functions as F, types as T

from marketlake.session import scratch_path

from .common import col, materialise, scale_partitions, small_batches

#: Bytes after which a task begins another archive file.
FILE_BYTES = 1 << 30
#: Bytes of an archive that one read fetches at most, and that one key deals to a task.
SPAN = 8 << 20
#: Bytes of archives that a task reads, where there are many.
TASK_BYTES = 64 << 20
#: Unwanted bytes between two wanted records that are read rather than skipped.
GAP = 64 << 10
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("key", pa.string()), ("url", pa.string()),
    ("digest", pa.string()), ("payload_bytes", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.string())])
INDEX_DDL = ("file string, offset long, length long, key string, url string, digest string, "
             "payload_bytes long, record_type string, refers_to string")
READ_DDL = "key string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a Hadoop-style URI and the path there."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parts.path if parts.scheme else uri
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a 160-bit hex digest: 20 bits, four letters, at a time."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _head(lines: list[tuple[str, str | None]], size: int) -> bytes:
    text = "".join(f"{k}: {v}\r\n" for k, v in [*lines, ("Content-Length", str(size))] if v is not None)
    return ("WARC/1.1\r\n" + text + "\r\n").encode()


def _record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(parts).encode()).digest())}>"


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def record(key, url, digest: str, size: int, payload: bytes | None, refers_to, refers_url, n: int, date: str) -> bytes:
    """A response record, or a revisit where ``payload`` is None; ``n`` tells rows with equal fields apart."""
    target = None if url is None else quote(url, safe="%/:?#[]@!$&'()*+,;=-._~")
    common = [("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Key", _line(key)),
              ("X-Payload-Length", str(size))]
    if payload is not None:
        block = _http(size) + payload
        kind = [("WARC-Type", "response"), ("WARC-Record-ID", _record_id(digest, size)),
                ("Content-Type", "application/http; msgtype=response")]
    else:
        block = _http(size)
        there = None if refers_url is None else quote(refers_url, safe="%/:?#[]@!$&'()*+,;=-._~")
        kind = [("WARC-Type", "revisit"), ("WARC-Record-ID", _record_id(digest, size, key, url, n)),
                ("WARC-Refers-To", _record_id(digest, size)), ("WARC-Refers-To-Target-URI", there), ("WARC-Refers-To-Date", date),
                ("WARC-Profile", PROFILE), ("X-Refers-To-Key", _line(refers_to)), ("Content-Type", "application/http; msgtype=response")]
    return _head(kind + common, len(block)) + block + b"\r\n\r\n"


def _line(value: str | None) -> str | None:
    """A header value on one line: percent-encoded as far as it isn't printable ASCII."""
    return None if value is None else quote(value, safe=" !\"#$&'()*+,-./:;<=>?@[\\]^_`{|}~")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one unpacked record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    size = int(headers.get("content-length", -1))
    if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return headers, rest[:size]


def _pack(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)  # 31: a gzip member
    return z.compress(data) + z.flush()


def _writer(root: str, date: str, file_bytes: int):
    """Rows (key, url, digest, size, payload, refers_to, refers_url, n) -> archive files and their index rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(root)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                rows = []
                for key, url, digest, size, payload, to, to_url, n in zip(*[c.to_pylist() for c in batch.columns]):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        fs.create_dir(folder, recursive=True)
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                        body = b"software: marketlake\r\nformat: WARC File Format 1.1\r\n"
                        info = _pack(_head([("WARC-Type", "warcinfo"), ("WARC-Date", date), ("WARC-Record-ID", _record_id(name)),
                                            ("Content-Type", "application/warc-fields")], len(body)) + body + b"\r\n\r\n")
                        out.write(info)
                        at = len(info)
                    data = _pack(record(key, url, digest, size, payload, to, to_url, n, date))
                    out.write(data)
                    kind = "revisit" if payload is None else "response"
                    rows.append((f"{root}/{name}", at, len(data), key, url, digest, size, kind, to))
                    at += len(data)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), INDEX)], schema=INDEX)
        finally:
            if out is not None:
                out.close()

    return run


def write(pages: DataFrame, root: str | None = None, key_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", date: str = DATE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for each row of ``pages`` under ``root``; returns the index (a written table).

    Keys go through the archive as text; ``refers_to`` is the key of the response that a revisit names.
    """
    spark = pages.sparkSession
    small_batches(spark)
    root = (root or scratch_path(spark, f"warc-{uuid.uuid4().hex}")).rstrip("/")
    key, url = col(key_col), col(url_col)
    payload = F.coalesce(col(payload_col).cast("string"), F.lit(""))
    told = [base32(F.sha1(payload)).alias("digest"), F.octet_length(payload).cast("long").alias("size")]
    # what the largest row of a payload is: nulls smallest
    order = [key.isNotNull().alias("has_key"), key.alias("key"), url.isNotNull().alias("has_url"), url.alias("url")]
    none = F.lit(None).cast("string")

    whole = pages.select(*told, F.struct(*order).alias("at"), payload.cast("binary").alias("payload"))
    first = whole.groupBy("digest", "size").agg(F.max("at").alias("at"), F.first("payload").alias("payload"))
    responses = first.select(F.col("at.key").cast("string").alias("key"), "at.url", "digest", "size", "payload",
                             none.alias("refers_to"), none.alias("refers_url"), F.lit(0).cast("long").alias("n"))
    written = materialise(responses.mapInArrow(_writer(root, date, file_bytes), INDEX_DDL), "warc-responses")

    # rows without their payloads, numbered and written: which of equal rows is the response stays fixed
    narrow = materialise(pages.select(*told, F.struct(*order, (-F.monotonically_increasing_id()).alias("n")).alias("at")), "warc-rows")
    best = materialise(narrow.groupBy("digest", "size").agg(F.max("at").alias("best"), F.count(F.lit(1)).alias("m"))
                       .where("m > 1").drop("m"), "warc-repeated")
    again = narrow.join(best, ["digest", "size"]).where(F.col("at.n") != F.col("best.n"))
    revisits = again.select(F.col("at.key").cast("string").alias("key"), "at.url", "digest", "size", F.lit(None).cast("binary").alias("payload"),
                            F.col("best.key").cast("string").alias("refers_to"), F.col("best.url").alias("refers_url"), F.col("at.n").alias("n"))
    also = materialise(revisits.mapInArrow(_writer(root, date, file_bytes), INDEX_DDL), "warc-revisits")
    return written.unionByName(also)


def _reader(span: int, gap: int, with_payload: bool):
    """Index rows in order of (file, offset) -> their records, fetched by coalesced ranges."""
    names = ["key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    if with_payload:
        names, types = [*names, "payload"], [*types, pa.binary()]

    def unpack(row: tuple, data: bytes) -> tuple:
        file, offset, _, key, url, digest, size, kind, to = row
        headers, block = parse(zlib.decompress(data, 31))
        payload = None
        if headers["warc-type"] == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            found, length = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        else:
            found, length = headers["warc-payload-digest"].removeprefix("sha1:"), int(headers["x-payload-length"])
        if (headers["warc-type"], found, length, headers.get("x-key"), headers.get("x-refers-to-key")) != (kind, digest, size, _line(key), _line(to)):
            raise ValueError(f"record at {offset} of {file} isn't what its index row says")
        out = (key, url, length, found, headers["warc-type"], to)
        return (*out, payload) if with_payload else out

    def fetch(held: list[tuple]) -> pa.RecordBatch:
        fs, path = filesystem(held[0][0])
        start = held[0][1]
        with fs.open_input_file(path) as f:
            data = f.read_at(held[-1][1] + held[-1][2] - start, start)
        rows = [unpack(r, data[r[1] - start : r[1] - start + r[2]]) for r in held]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (row[0] != held[0][0] or row[1] - held[-1][1] - held[-1][2] > gap or row[1] + row[2] - held[0][1] > span):
                    yield fetch(held)
                    held = []
                held.append(row)
        if held:
            yield fetch(held)

    return run


def read(index: DataFrame, with_payload: bool = False, span: int = SPAN, gap: int = GAP) -> DataFrame:
    """The records that index rows name: key, url, payload_bytes, payload_digest, record_type, refers_to.

    Each index row gives one record, repeated ones too; ``with_payload`` adds the bytes (null for a revisit).
    """
    small_batches(index.sparkSession)
    # tasks by the bytes they fetch: the index rows themselves are too few to tell
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(scale_partitions(total, TASK_BYTES), min(scale_partitions(total, span), index.sparkSession.sparkContext.defaultParallelism))
    dealt = (index.select(*INDEX.names).repartition(tasks, F.col("file"), F.floor(F.col("offset") / span))
             .sortWithinPartitions("file", "offset"))
    return dealt.mapInArrow(_reader(span, gap, with_payload), READ_DDL + (", payload binary" if with_payload else ""))


def digest(records: DataFrame, key_type: T.DataType) -> DataFrame:
    return records.select(F.col("key").cast(key_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          F.col("refers_to").cast(key_type).alias("refers_to"))
