"""WARC archives: monolithic gzip files rewritten with one member per record and an offset index beside them.

A file compressed as one gzip stream can only be read from its start. The normaliser inflates it once, as a stream,
writes every record as a member of its own and notes the members' places in a sidecar file, after which any record can be read
by itself. Files are the unit of parallel work; within one, memory holds a record and a buffer.

Files may come from anywhere: headers are read as the standard has them (any letter case, folded lines, space after the colon or
none), and records of all types go through byte for byte. Records written here have all mandatory headers; a page is the body
of an HTTP response, so that other readers find it.

Archives lie in a folder that all executors share. Names hold a random part, and only files listed in a manifest that
Spark committed count, so a task that runs twice leaves an unlisted file and nothing else.
"""

from __future__ import annotations

import json
import re
import string
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm.common import cut, small, table
from bazaarlake.session import work_dir

LEAST = 100
ARCHIVE_BYTES = 256 << 20
BUFFER = 1 << 20
LEVEL = 4
#: A record's headers take no more.
MOST_HEAD = 1 << 20
_URI_SAFE = string.punctuation


def _open(uri: str):
    return fs.FileSystem.from_uri(uri)


#: Fixed values of the WARC 1.1 standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
_DATE = "%Y-%m-%dT%H:%M:%SZ"
#: Where a URL can't stand in a header as it is (line ends, other control characters), its exact form is written beside it.
_EXACT_URI = "X-Exact-URI"


def record(
    page_id: int | None, url: str | None, kind: str, payload: bytes, full_bytes: int, digest: str, refers_to: int | None, date: str
) -> bytes:
    """One WARC/1.1 record. A revisit has no payload; its headers have the full payload's length and digest, and the page it repeats.

    A page without id gets a random record id.
    """
    name = lambda i: f"<urn:uuid:{uuid.uuid4()}>" if i is None else f"<urn:page:{i}>"
    plain = url is not None and url.isprintable() and url == url.strip()
    body = HTTP_HEAD + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {url if plain else quote(url or '', safe=_URI_SAFE) or 'urn:none'}",
        *([] if plain else [f"{_EXACT_URI}: {json.dumps(url)}"]),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {full_bytes}",
        *([f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"] if kind == "revisit" else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def inflated(chunks: Iterable[bytes], most: int = BUFFER) -> Iterator[bytes]:
    """The content of a gzip file of one or many members, in pieces of bounded size."""
    inflate = zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            if piece := inflate.decompress(chunk, most):
                yield piece
            chunk = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
    if piece := inflate.flush():
        yield piece
    if not inflate.eof:
        raise ValueError("the gzip stream is cut short")


def records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of each record in a stream of inflated pieces; holds one record at a time."""
    held = bytearray()
    pieces = iter(pieces)

    def fill(enough) -> bool:
        while not enough():
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        while not held or held[0] in b"\r\n":  # empty lines behind a record, two by the standard
            if held:
                del held[: len(held) - len(held.lstrip(b"\r\n"))]
            elif not fill(lambda: held):
                return
        if not fill(lambda: b"\r\n\r\n" in held):
            raise ValueError("the last record is cut short")
        end = held.index(b"\r\n\r\n") + 4
        if end > MOST_HEAD:
            raise ValueError("a record's headers have no end")
        headers = headers_of(bytes(held[:end]))
        whole = end + int(headers["content-length"])
        if not fill(lambda: len(held) >= whole):
            raise ValueError("the last record is cut short")
        yield headers, bytes(held[:whole]) + b"\r\n\r\n"
        del held[:whole]


def headers_of(head: bytes) -> dict[str, str]:
    """A record's headers by lower-case name; lines that begin with white space go on with the line before."""
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    out, last = {}, None
    for line in lines:
        if line[:1] in (" ", "\t") and last:
            out[last] = f"{out[last]} {line.strip()}".strip()
        elif line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            out[last] = value.strip()
    if "content-length" not in out:
        raise ValueError("a record has no Content-Length")
    return out


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """What a record holds: of an HTTP message its body, else the whole block."""
    if headers.get("content-type", "").lower().startswith("application/http") and headers.get("warc-type") in ("response", "request", "revisit"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def target_of(headers: dict[str, str]) -> str | None:
    exact = headers.get(_EXACT_URI.lower())
    uri = headers.get("warc-target-uri")
    return json.loads(exact) if exact else uri[1:-1] if uri and uri[0] == "<" and uri[-1] == ">" else uri


def _read_chunks(uri: str) -> Iterator[bytes]:
    system, path = _open(uri)
    with system.open_input_stream(path, compression=None) as f:
        while chunk := f.read(BUFFER):
            yield chunk


def _listed(rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["archive", "records", "bytes"]
    )


LISTED = "archive string, records long, bytes long"


def _monolith_writer(folder: str, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        out = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, deflate, n, size = system.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(1, wbits=31), 0, 0
                payload = (row["html"] or "").encode()
                revisit = row["refers_to"] is not None
                kind = "revisit" if revisit else "response"
                body = b"" if revisit else payload
                data = record(row["page_id"], row["url"], kind, body, len(payload), row["digest"], row["refers_to"], date)
                out.write(deflate.compress(data))
                n, size = n + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.write(deflate.flush())
                    out.close()
                    out = None
                    yield _listed([(f"{folder}/{name}", n, size)])
        if out is not None:
            out.write(deflate.flush())
            out.close()
            yield _listed([(f"{folder}/{name}", n, size)])

    return write


def _member(data: bytes) -> bytes:
    deflate = zlib.compressobj(LEVEL, wbits=31)
    return deflate.compress(data) + deflate.flush()


def _normaliser(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                name, at, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                with (
                    system.open_output_stream(f"{base}/{name}", compression=None) as out,
                    system.open_output_stream(f"{base}/{name}.idx", compression=None) as index,
                ):
                    for headers, data in records(inflated(_read_chunks(uri))):
                        member = _member(data)
                        out.write(member)
                        entry = {"id": headers.get("warc-record-id"), "type": headers.get("warc-type"), "url": target_of(headers), "offset": at, "length": len(member)}
                        index.write(json.dumps(entry).encode() + b"\n")
                        at, n = at + len(member), n + 1
                yield _listed([(f"{folder}/{name}", n, at)])

    return run


_PAGE = re.compile(r"<?urn:page:(-?\d+)>?")


def _page(name: str | None) -> int | None:
    """The page of a record id written here; other ids name none."""
    found = _PAGE.fullmatch(name or "")
    return int(found[1]) if found else None


READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, "
    "record_id string, date string, content_type string"
)


def _reader(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.string(), pa.string()]
        names = [c.split()[0] for c in READ.split(", ")]

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                system, path = _open(uri)
                rows, held = [], 0
                with system.open_input_stream(f"{path}.idx", compression=None) as index, system.open_input_file(path) as archive:
                    for line in _lines(index):
                        entry = json.loads(line)
                        archive.seek(entry["offset"])
                        data = zlib.decompress(archive.read(entry["length"]), 31)
                        end = data.index(b"\r\n\r\n") + 4
                        headers = headers_of(data[:end])
                        payload = payload_of(headers, data[end : end + int(headers["content-length"])])
                        kind, noted = headers.get("warc-type"), headers.get("warc-payload-digest", "")
                        own = hashlib.sha256(payload).hexdigest()
                        digest = noted.removeprefix("sha256:") if noted.startswith("sha256:") else own
                        if kind != "revisit" and digest != own:
                            raise ValueError(f"record {entry['id']} of {uri} is damaged")
                        rows.append(
                            (_page(headers.get("warc-record-id")), target_of(headers), int(headers.get("x-payload-length", len(payload))), digest, kind,
                             _page(headers.get("warc-refers-to")), payload if with_payload else None,
                             headers.get("warc-record-id"), headers.get("warc-date"), headers.get("content-type"))
                        )
                        held += len(payload) + 200
                        if held > BUFFER * 8:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    return run


def _lines(stream) -> Iterator[bytes]:
    rest = b""
    while chunk := stream.read(BUFFER):
        *lines, rest = (rest + chunk).split(b"\n")
        yield from lines


def write_monoliths(pages: DataFrame, folder: str) -> DataFrame:
    """Writes each partition of ``pages`` (page_id, url, html, digest, refers_to) as gzip files of one stream; returns their manifest."""
    _make(folder)
    date = datetime.now(timezone.utc).strftime(_DATE)
    return cut(pages.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(_monolith_writer(folder, date), LISTED))


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrites WARC files (column ``archive``; one gzip stream or many) with a member per record and a sidecar index ``.idx``.

    Files are dealt out evenly, one task each where there are enough tasks. Returns the new files' manifest. A file that ends
    in the middle of a stream or record is an error.
    """
    _make(folder)
    n = max(archives.count(), 1)
    width = max(archives.sparkSession.sparkContext.defaultParallelism, min(n, 100_000))
    return cut(archives.select("archive").repartition(width).mapInArrow(_normaliser(folder), LISTED))


def read_records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of normalised archives, of every type, read member by member through the sidecar index.

    ``page_id`` and ``refers_to`` are null for record ids that were not made here. A payload that differs from its noted SHA-256
    is an error; other digests are not looked at, and a record without one has its own.
    """
    return archives.select("archive").mapInArrow(_reader(with_payload), READ)


def _make(folder: str) -> None:
    system, path = _open(folder)
    system.create_dir(path)


def with_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``page_id, url, html, digest, refers_to``: of pages with equal payloads of ``least`` bytes or more, all but that of the
    smallest page_id refer to it.

    Null html is an empty payload. Rows repeating that smallest id are responses too; rows without id refer to it, and are all
    responses if the whole group has no id.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"), (F.octet_length(payload) >= least).alias("long"))
    groups = pages.where("long").groupBy(F.col("digest").alias("_digest")).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = small(cut(groups.where("n > 1").select("_digest", "first")), 500_000)  # up to 40 MB: payloads stay put
    differs = F.col("long") & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return pages.join(groups, F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "html", "digest", F.when(differs, F.col("first")).alias("refers_to")
    )


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``pages`` as monolithic archives, normalises them and returns the manifest of the normalised ones."""
    return normalise(write_monoliths(with_revisits(pages), f"{folder}/monolithic"), f"{folder}/records")


def op4_gzip_normaliser(spark, sf_dir):
    archives = archive_pages(spark, table(spark, sf_dir, "pages").select("page_id", "url", "html"), work_dir(spark, "warc"))
    return read_records(archives, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
