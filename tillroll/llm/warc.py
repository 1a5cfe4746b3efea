"""Operator 3: WARC archives as a table of record chunks.

Writing: each page is one record.  Its payload travels as rows of (record,
chunk number, bytes), never as one value in a Python worker, and is appended to the
archive as it comes while a running digest is kept.  Each task writes one
archive of gzip members, one for each record, under a name of its own attempt; only
archives named in the returned index count, so a task that is run again
leaves no half archive in the result.

Reading: each span of the index is streamed to rows of (record, chunk number,
bytes), with the payload's digest up to and including the chunk.  The last
chunk's digest must be the one in the record's header.

Of records with equal payloads of at least ``REVISIT_BYTES`` the one with the
largest page id is a response, and the others are revisits of it without payload.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.workspace import fresh_path, stored
from tillroll.llm.common import bounded, utf8

REVISIT_BYTES = 1000
CHUNK = 256 * 1024
# Bytes of an archive that one task reads, about (a record is never split).
SPAN = 16 * 1024 * 1024
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LEVEL = 3
_ROWS = 64

_INDEX = "path string, start bigint, stop bigint, records bigint"
_CHUNKS = ("page_id bigint, record_type string, refers_to bigint, chunk_no int, "
           "chunk_start bigint, data binary, digest string, last boolean, "
           "payload_bytes bigint, payload_digest string")


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that all executors share, and the path in it."""
    path = re.sub(r"^s3[an]:", "s3:", path)
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def record_chunks(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                  html: str = "html", chunk: int = CHUNK) -> DataFrame:
    """The chunk rows of the records to write, a record's rows in order.

    Digests are taken in a first scan without the payloads' bytes.  Only payloads of
    ``REVISIT_BYTES`` or more are looked up by digest, so empty and small ones, however many,
    stay where they are read.
    """
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"),
                        F.col(url).cast("string").alias("url"), utf8(html).alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    rows = rows.withColumn("payload_digest", F.sha1("payload"))
    large = rows.where(f"payload_bytes >= {REVISIT_BYTES}")
    # Written first, so that both sides of the join come from an exchange of their own and
    # adaptive execution can split a payload that many pages have.
    copies = stored(large.groupBy("payload_digest")
                    .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
                    .where("n > 1").select("payload_digest", "response_id"), "copies")
    large = large.join(copies, "payload_digest", "left").withColumn(
        "refers_to", F.expr("IF(page_id IS NULL OR page_id < response_id, response_id, NULL)"))
    small = rows.where(f"payload_bytes < {REVISIT_BYTES}").withColumn(
        "refers_to", F.lit(None).cast("bigint"))
    rows = large.drop("response_id").unionByName(small)
    pieces = (f"IF(refers_to IS NOT NULL OR payload_bytes = 0, array(CAST('' AS binary)), "
              f"transform(sequence(1L, payload_bytes, {chunk}L), "
              f"i -> substring(payload, CAST(i AS int), {chunk})))")
    return rows.selectExpr("page_id", "url", "payload_bytes", "payload_digest", "refers_to",
                           f"posexplode({pieces}) AS (chunk_no, data)")


def _header(row: dict) -> bytes:
    name = "none" if row["page_id"] is None else row["page_id"]
    target = row["url"] or f"urn:page:{name}"
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", target)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    revisit = row["refers_to"] is not None
    http += f"Content-Length: {row['payload_bytes']}\r\n\r\n".encode()
    size = len(http) + (0 if revisit else row["payload_bytes"])
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}:{row['payload_digest']}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {size}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{row['refers_to']}:{row['payload_digest']}>",
                  f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes chunk rows to archives in a shared ``folder``; returns their index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex}"
        out = pack = None
        path = f"{folder.rstrip('/')}/{name}.warc.gz"
        spans, start, count, seen, expected = [], 0, 0, None, ""

        def close_record() -> None:
            if seen is not None and seen.hexdigest() != expected:
                raise ValueError(f"payload digest changed on the way to {path}")
            out.write(pack.compress(b"\r\n\r\n") + pack.flush())

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    store, place = _store(path)
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(place, compression=None)
                if row["chunk_no"] == 0:
                    if pack is not None:
                        close_record()
                        if out.tell() - start >= SPAN:
                            spans.append((path, start, out.tell(), count))
                            start, count = out.tell(), 0
                    pack = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
                    out.write(pack.compress(_header(row)))
                    seen = None if row["refers_to"] is not None else hashlib.sha1()
                    expected = row["payload_digest"]
                    count += 1
                if seen is not None:
                    seen.update(row["data"])
                    out.write(pack.compress(row["data"]))
        if out is not None:
            close_record()
            spans.append((path, start, out.tell(), count))
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([s[i] for s in spans]) for i in range(4)],
                names=["path", "start", "stop", "records"])

    bounded(records.sparkSession, _ROWS)
    return stored(records.mapInArrow(run, _INDEX), "index")


def _unpacked(path: str, start: int, stop: int) -> Iterator[bytes | None]:
    """The bytes of the gzip members of a span in pieces; None ends each member."""
    store, place = _store(path)
    with store.open_input_file(place) as source:
        source.seek(start)
        unpack, left = zlib.decompressobj(31), stop - start
        data = b""
        while True:
            if not data and left:
                data = source.read(min(left, CHUNK))
                if not data:
                    raise ValueError(f"{path} ends early")
                left -= len(data)
            over = not data
            piece = unpack.decompress(data, CHUNK)
            if piece:
                yield piece
            elif over:
                return
            data = unpack.unconsumed_tail
            if unpack.eof:
                data = unpack.unused_data
                unpack = zlib.decompressobj(31)
                yield None


def _records(pieces: Iterator[bytes | None], chunk: int) -> Iterator[dict]:
    """Chunk rows of the records, at most a chunk and a piece in memory."""
    held = b""

    def fields(block: bytes) -> dict[str, str]:
        lines = block.decode().split("\r\n")[1:]
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}

    def number(name: str) -> int | None:
        found = name.strip("<>").split(":")[2]
        return None if found == "none" else int(found)

    while True:
        while b"\r\n\r\n" not in held:
            piece = next(pieces, None)
            if piece is None:
                if held:
                    raise ValueError("a record ends within its header")
                return
            held += piece
        block, _, held = held.partition(b"\r\n\r\n")
        head = fields(block)
        while b"\r\n\r\n" not in held:
            held += next(pieces) or b""
        http, _, held = held.partition(b"\r\n\r\n")
        size = int(head["content-length"]) - len(http) - 4
        revisit = head["warc-type"] == "revisit"
        row = {
            "page_id": number(head["warc-record-id"]), "record_type": head["warc-type"],
            "refers_to": number(head["warc-refers-to"]) if revisit else None,
            "payload_digest": head["warc-payload-digest"].removeprefix("sha1:"),
            "payload_bytes": int(fields(http)["content-length"]),
        }
        digest, done, chunk_no = hashlib.sha1(), 0, 0
        while done < size or chunk_no == 0:
            while len(held) < min(chunk, size - done):
                piece = next(pieces)
                if piece is None:
                    raise ValueError("a record ends within its payload")
                held += piece
            part = held[:min(chunk, size - done)]
            held = held[len(part):]
            digest.update(part)
            done += len(part)
            if done == size and not revisit and digest.hexdigest() != row["payload_digest"]:
                raise ValueError(f"record of page {row['page_id']} has another digest")
            yield row | {"chunk_no": chunk_no, "chunk_start": done - len(part), "data": part,
                         "digest": None if revisit else digest.hexdigest(), "last": done == size}
            chunk_no += 1
        # The two line ends after the block, and the end of the member.
        for piece in pieces:
            if piece is None:
                break
            held += piece
        if held != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        held = b""


def read_archives(spark: SparkSession, index: DataFrame, chunk: int = CHUNK,
                  with_data: bool = True) -> DataFrame:
    """Chunk rows of all records in the archives of an index, one span a task at a time."""
    spans = index.count()

    schema = spark.createDataFrame([], _CHUNKS).schema
    names = schema.fieldNames()
    types = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(),
             pa.string(), pa.bool_(), pa.int64(), pa.string()]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)],
            names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span in batch.to_pylist():
                rows, size = [], 0
                pieces = _unpacked(span["path"], span["start"], span["stop"])
                for row in _records(pieces, chunk):
                    size += len(row["data"]) + 200
                    if not with_data:
                        row["data"] = None
                    rows.append(row)
                    if size >= 16 * chunk:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return index.repartition(max(1, spans)).mapInArrow(run, schema)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url",
               html: str = "html", folder: str | None = None) -> DataFrame:
    """Writes archives of the pages, reads them back, and returns a row per record.

    A null html is an empty payload.  Without page id a record is never the one
    that others refer to, if its payload has another with an id.  Rows that
    repeat a page with its payload are all responses, or all revisits.  An empty
    table writes no archive.  Other columns are not read.
    """
    spark = pages.sparkSession
    index = write_archives(record_chunks(pages, page_id, url, html),
                           folder or fresh_path(spark, "archives"))
    rows = read_archives(spark, index, with_data=False).where("last")
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest
  FROM pages),
g AS (SELECT digest, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id < top OR page_id IS NULL AND top IS NOT NULL THEN 'revisit'
    ELSE 'response' END AS record_type,
  CASE WHEN page_id < top OR page_id IS NULL THEN top END AS refers_to
FROM p LEFT JOIN g USING (digest)
"""
