"""WARC archives: write, normalise to one gzip member a record, read back by offset.

Tasks write records into whole-file gzip streams below the shared folder and
return the files they finished.  The normaliser inflates such a stream once,
front to back, rewrites each record as a gzip member of its own and writes a
sidecar with every member's offset.  Readers then fetch single members.  A
task that runs again writes files of new names, and only files named in a
written table are read, so lost executors leave nothing half done in use.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.llm.text import filled
from linkmill.plans.lineage import fresh_path, materialize, stored
from linkmill.plans.sizes import small_side

#: payloads of fewer bytes are never revisits
LEAST_REVISIT = 1000
#: payload bytes after which a task starts a new archive
ROLL = 64 << 20
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_GZIP = 31
_END = b"\r\n"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    # Spark also writes file:/folder, which has no host part
    return fs.FileSystem.from_uri("/" + path[5:].lstrip("/") if path.startswith("file:/") else path)


def record_name(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{page_id}')}>"


def record(page_id, url, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    """One WARC record; a revisit (``refers_to``) carries no payload."""
    body = payload if refers_to is None else b""
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_name(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else " ".join(url.split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", None if refers_to is None else record_name(refers_to)),
        ("X-Refers-To-Page", refers_to),
        ("X-Page", page_id),
        ("X-Payload-Length", size),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", len(body)),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + _END + body + _END + _END


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines) if k}


def records_of(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(header fields, whole record)`` from a stream of inflated bytes."""
    held = bytearray()
    more = True

    def fill() -> bool:
        piece = next(pieces, None)
        if piece is None:
            return False
        held.extend(piece)
        return True

    while more:
        while (cut := held.find(_END + _END)) < 0 and (more := fill()):
            pass
        if cut < 0:
            if held.strip():
                raise ValueError("archive ends inside a record header")
            return
        head = _fields(bytes(held[:cut]))
        end = cut + 4 + int(head["content-length"]) + 4
        while len(held) < end:
            if not fill():
                raise ValueError("archive ends inside a record")
        yield head, bytes(held[:end])
        del held[:end]


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of any number of members, read front to back once."""
    unzip = zlib.decompressobj(_GZIP)
    while data := stream.read(CHUNK):
        while data:
            piece = unzip.decompress(data, CHUNK)
            if piece:
                yield piece
            data = unzip.unconsumed_tail
            if unzip.eof:
                data, unzip = unzip.unused_data, zlib.decompressobj(_GZIP)
    if rest := unzip.flush():
        yield rest


_ROW = "page_id long, url string, payload binary, digest string, size long, refers_to long"


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``rows`` into whole-file gzip archives; returns ``path, records`` of each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        out, done = None, []
        count = size = 0

        def close() -> None:
            out.write(gzip.flush())
            out.close()
            done.append((name, count))

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if out is None:
                    name, gzip, count, size = f"{uuid.uuid4().hex}.warc.gz", zlib.compressobj(1, wbits=_GZIP), 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                data = record(*row)
                out.write(gzip.compress(data))
                count, size = count + 1, size + len(data)
                if size >= ROLL:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{n}" for n, _ in done], "records": pa.array([c for _, c in done], pa.int64())}, pa.schema([("path", pa.string()), ("records", pa.int64())]))

    return materialize(rows.mapInArrow(write, "path string, records long"), "archives")


_INDEX = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64())])


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite ``archives(path)`` with one member a record; returns the index rows.

    Beside each new file lies ``<file>.idx``, the same rows as JSON lines.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            name = f"{uuid.uuid4().hex}.warc.gz"
            source, at = _store(path)
            rows, offset = [], 0
            with source.open_input_stream(at, compression=None) as stream, store.open_output_stream(f"{base}/{name}", compression=None) as out:
                for head, data in records_of(inflated(stream)):
                    gzip = zlib.compressobj(6, wbits=_GZIP)
                    member = gzip.compress(data) + gzip.flush()
                    out.write(member)
                    page = head.get("x-page")
                    rows.append({"path": f"{folder}/{name}", "offset": offset, "length": len(member), "page_id": None if page is None else int(page)})
                    offset += len(member)
            with store.open_output_stream(f"{base}/{name}.idx", compression=None) as out:
                out.write("".join(json.dumps(row) + "\n" for row in rows).encode())
            yield pa.RecordBatch.from_pylist(rows, _INDEX)

    files = archives.select("path")
    many = max(archives.count(), 1)
    index = files.repartition(many, "path").mapInArrow(rewrite, "path string, offset long, length long, page_id long")
    return materialize(index, "index")


_READ = pa.schema([("page_id", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records at ``index(path, offset, length)``, each inflated by itself.

    A response's size and digest come from its payload, a revisit's from its
    header; a response that differs from its header's digest is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for batch in batches:
            rows = []
            for path, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if path != opened:
                    if file is not None:
                        file.close()
                    store, at = _store(path)
                    opened, file = path, store.open_input_file(at)
                file.seek(offset)
                data = zlib.decompress(file.read(length), _GZIP)
                head = _fields(data[: data.index(_END + _END)])
                body = data[len(data) - 4 - int(head["content-length"]) : len(data) - 4]
                revisit = head["warc-type"] == "revisit"
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                if not revisit and sha1(body).hexdigest() != digest:
                    raise ValueError(f"payload of {head['warc-record-id']} differs from its digest")
                page, refers = head.get("x-page"), head.get("x-refers-to-page")
                rows.append({
                    "page_id": None if page is None else int(page),
                    "payload": body if payloads else None,
                    "payload_bytes": int(head["x-payload-length"]) if revisit else len(body),
                    "payload_digest": digest,
                    "record_type": head["warc-type"],
                    "refers_to": None if refers is None else int(refers),
                })
            yield pa.RecordBatch.from_pylist(rows, _READ)
        if file is not None:
            file.close()

    schema = "page_id long, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    # one task per archive: the number is given, as the index is far smaller than what it points to
    many = max(index.agg(F.count_distinct("path")).first()[0], 1)
    return index.select("path", "offset", "length").repartition(many, "path").sortWithinPartitions("path", "offset").mapInArrow(read, schema)


def archive_rows(pages: DataFrame, html: str = "html", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``pages`` as archive rows: payload, digest, size and the page a revisit refers to.

    Of equal payloads of LEAST_REVISIT bytes or more the largest page id is the
    response; null html is empty.  A null page id is a revisit if its payload has
    a page with an id, else a response.  Rows that repeat an id are records each.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        filled(F.col(html)).cast("binary").alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    first = (
        rows.where(F.col("size") >= LEAST_REVISIT)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    same = F.col("page_id").eqNullSafe(F.col("first"))
    # payloads stay where they are while the list of repeated ones can be sent; a revisit has none
    found = rows.join(small_side(stored(first, "repeated")), ["digest", "size"], "left")
    refers = F.when(~same, F.col("first"))
    payload = F.when(refers.isNull(), F.col("payload")).otherwise(F.lit(b""))
    return found.select("page_id", "url", payload.alias("payload"), "digest", "size", refers.alias("refers_to"))


def round_trip(pages: DataFrame, payloads: bool = False, **columns: str) -> DataFrame:
    """Archive ``pages``, normalise the archives and read every record back."""
    spark = pages.sparkSession
    archives = write_archives(archive_rows(pages, **columns), fresh_path(spark, "archives"))
    index = normalise(archives, fresh_path(spark, "members"))
    return read_records(index, payloads)
