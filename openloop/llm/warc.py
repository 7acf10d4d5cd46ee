"""WARC archives of pages: written by tasks, read back sequentially.

Every record is a gzip member of its own. The reader takes a stream in small reads, inflates
member by member, frames the record by its content length and verifies both digests, so it holds
one record at a time. Archives are real files in a folder that all executors share; a task names
its files anew at every attempt and only files of finished attempts get into the manifest.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openloop.functions.durable import shared_folder, staged
from openloop.llm.texts import text_bytes

#: A task starts another archive once one has this many bytes.
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 16

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None,
           revisit: bool, date: str) -> bytes:
    """One gzip member: a response with its payload, or a revisit that names the response."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    name = f"urn:page:{quote(page_id, safe='')}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{name}>",
        "WARC-Date": date,
        "Content-Type": "application/http;msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest32(payload)}",
        "WARC-Block-Digest": f"sha1:{digest32(block)}",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        fields["WARC-Target-URI"] = quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    if revisit:
        fields["WARC-Profile"] = REVISIT_PROFILE
        fields["WARC-Refers-To"] = f"<urn:page:{quote(refers_to, safe='')}>"
    head = b"\r\n".join([VERSION, *(f"{k}: {v}".encode() for k, v in fields.items())])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def read_records(stream, read_bytes: int = READ_BYTES) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields in lower case, block) of each record of a gzipped archive, in order."""
    pending = stream.read(read_bytes)
    while pending:
        member, held, need = zlib.decompressobj(31), bytearray(), None
        while not member.eof:
            if not pending and not (pending := stream.read(read_bytes)):
                raise ValueError("the archive ends inside a record")
            held += member.decompress(pending)
            pending = member.unused_data
            if need is None and (end := held.find(b"\r\n\r\n")) >= 0:
                lines = held[:end].decode().split("\r\n")
                fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                if not lines[0].startswith("WARC/") or not fields.get("content-length", "").isdigit():
                    raise ValueError("not a WARC record")
                need = end + 4 + int(fields["content-length"])
        if need is None or len(held) != need + 4 or held[need:] != b"\r\n\r\n":
            raise ValueError("the record is not as long as its content length says")
        block = bytes(held[end + 4 : need])
        if fields.get("warc-block-digest", f"sha1:{digest32(block)}") != f"sha1:{digest32(block)}":
            raise ValueError(f"block digest of {fields.get('warc-record-id')} differs")
        yield fields, block
        pending = pending or stream.read(read_bytes)


def page_of(fields: dict[str, str], block: bytes) -> tuple:
    """(page_id, url, type, refers_to, payload bytes, payload digest, payload) of a record. The
    length of a revisit's payload is the one its HTTP header states."""
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)[1])
    if kind == "response" and (digest32(payload), len(payload)) != (digest, size):
        raise ValueError(f"payload digest of {fields['warc-record-id']} differs")

    def ident(name: str | None) -> str | None:
        found = re.fullmatch("<urn:page:(.*)>", name or "")
        return unquote(found[1]) if found else None

    return (
        ident(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, ident(fields.get("warc-refers-to")),
        size, digest, payload if kind == "response" else None,
    )


def _open_folder(uri: str):
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path, recursive=True)
    return store, path


def mark_revisits(pages: DataFrame, min_bytes: int = 0, id_column: str = "page_id", url_column: str = "url",
                  payload_column: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to, revisit). Of pages with equal payloads of at least
    ``min_bytes`` the largest id is the response; rows that tie for it are all responses."""
    payload = text_bytes(F.col(payload_column))
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    largest = rows.groupBy("digest", "size").agg(F.max("page_id").alias("largest"))
    revisit = (F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return rows.join(largest, ["digest", "size"]).select(
        "page_id", "url", "payload", F.when(revisit, F.col("largest")).alias("refers_to"), revisit.alias("revisit")
    )


def write_archives(marked: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row of ``marked`` and returns the stored manifest (path, records)."""
    rows = marked.withColumns({n: F.col(n).cast("string") for n in ("page_id", "url", "refers_to")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open_folder(folder)
        path, stream, size, count = "", None, 0, 0

        def closed() -> pa.RecordBatch:
            stream.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([count], pa.int64())})

        for batch in batches:
            for page_id, url, payload, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if stream is None:
                    path, size, count = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    stream = store.open_output_stream(f"{root}/{posixpath.basename(path)}", compression=None)
                member = record(page_id, url, payload, refers_to, revisit, date)
                stream.write(member)
                size, count = size + len(member), count + 1
                if size >= archive_bytes:
                    yield closed()
                    stream = None
        if stream is not None:
            yield closed()

    columns = ("page_id", "url", "payload", "refers_to", "revisit")
    return staged(rows.select(*columns).mapInArrow(run, "path string, records long"))


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of the archives that ``manifest`` names (column ``path``)."""
    schema = pa.schema([
        ("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ])

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows), schema.types)), schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                held, size = [], 0
                with store.open_input_stream(name, compression=None) as stream:
                    for fields, block in read_records(stream):
                        held.append(page_of(fields, block))
                        size += len(block) + 200
                        if size > 4 << 20:
                            yield packed(held)
                            held, size = [], 0
                if held:
                    yield packed(held)

    archives = max(1, manifest.count())
    return manifest.select("path").repartition(archives).mapInArrow(
        run, "page_id string, url string, record_type string, refers_to string, payload_bytes long, "
        "payload_digest string, payload binary",
    )


def archived_pages(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, folder: str | None = None,
                   id_column: str = "page_id") -> DataFrame:
    """Writes ``pages`` as WARC archives and returns what reading them back gives.

    A null html is an empty payload, a null url leaves out the target, a null id gets a record
    name of its own and reads back as null (it is a response only where its payload has no known
    id). Repeated rows that tie for the largest id are all responses. An empty table gives no
    archive and no row; further columns are ignored.
    """
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    kind = pages.schema[id_column].dataType
    found = read_archives(write_archives(mark_revisits(pages, min_bytes, id_column), folder))
    return found.withColumns({n: F.col(n).cast(kind) for n in ("page_id", "refers_to")})
