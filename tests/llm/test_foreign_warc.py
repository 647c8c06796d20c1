"""Archives from elsewhere, and the headers of those written here."""

import gzip
import hashlib

import pytest

from bazaarlake.llm import warc
from bazaarlake.session import work_dir

HTTP = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"


def foreign():
    """(type, id, target, payload) and the bytes of a warcinfo, request, response, metadata, resource and revisit record."""
    body = "<p>é</p>".encode() * 40
    parts = [
        ("warcinfo", "<urn:uuid:1>", None, b"software: spider\r\n", "warc/1.0\r\nwarc-type:warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Type: application/warc-fields\r\nContent-Length:%d"),
        ("request", "<urn:uuid:2>", "http://a.b/c", b"", "WARC/1.0\r\nWARC-Type: request\r\nWARC-Record-ID: <urn:uuid:2>\r\nWARC-Target-URI: <http://a.b/c>\r\nContent-Type: application/http; msgtype=request\r\nContent-Length: %d"),
        ("response", "<urn:uuid:3>", "http://a.b/c", body, "WARC/1.1\r\nWARC-TYPE: response\r\nwarc-record-id: <urn:uuid:3>\r\nWARC-Target-URI:\r\n http://a.b/c\r\nWARC-Payload-Digest: sha1:ABC\r\nContent-Type: application/http;\r\n\tmsgtype=response\r\ncontent-length: %d"),
        ("metadata", "<urn:uuid:4>", "http://a.b/c", b"via: x\r\n\r\nmore", "WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:uuid:4>\r\nWARC-Target-URI: http://a.b/c\r\nContent-Length: %d"),
        ("resource", "<urn:uuid:5>", "ftp://a.b/d", b"", "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:5>\r\nWARC-Target-URI: ftp://a.b/d\r\nWARC-Date: 2020-01-02T03:04:05Z\r\nContent-Length: %d"),
    ]
    out = []
    for kind, name, target, payload, head in parts:
        block = {"request": b"GET /c HTTP/1.1\r\nHost: a.b\r\n\r\n", "response": HTTP + payload}.get(kind, payload)
        out.append(((kind, name, target, payload), head.replace("warc/1.0", "WARC/1.0").replace("%d", str(len(block))).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"))
    return out


@pytest.mark.parametrize("members", [True, False])
def test_records_of_all_types_go_through(spark, members):
    found, data = zip(*foreign(), strict=True)
    folder = work_dir(spark, "foreign").removeprefix("file:")
    warc._make(folder)
    packed = b"".join(gzip.compress(x) for x in data) if members else gzip.compress(b"".join(data) + b"\r\n")
    with open(f"{folder}/a.warc.gz", "wb") as f:
        f.write(packed)
    archives = spark.createDataFrame([(f"{folder}/a.warc.gz",)], "archive string")
    normal = warc.normalise(archives, f"{folder}/normal")
    rows = {r["record_id"]: r for r in warc.read_records(normal).collect()}
    assert len(rows) == len(found)
    for kind, name, target, payload in found:
        r = rows[name]
        assert (r["record_type"], r["url"], bytes(r["payload"]), r["payload_bytes"]) == (kind, target, payload, len(payload))
        assert r["page_id"] is None and r["refers_to"] is None and r["payload_digest"] == hashlib.sha256(payload).hexdigest()
    assert rows["<urn:uuid:5>"]["date"] == "2020-01-02T03:04:05Z"
    with open(normal.first()["archive"].removeprefix("file://"), "rb") as f:
        assert gzip.decompress(f.read()) == b"".join(data)  # byte for byte
    again = warc.normalise(normal.select("archive"), f"{folder}/again")
    assert {r["record_id"] for r in warc.read_records(again).collect()} == set(rows)


def test_written_records_have_all_mandatory_headers(spark):
    html = "<p>x</p>" * 30
    data = [(1, "http://a.b/ü c", html), (2, "line\r\nend\x00", html), (3, None, html), (None, " space ", "y"), (None, "u", None)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").coalesce(1)
    archives = warc.archive_pages(spark, pages, work_dir(spark, "headers"))
    kinds = {}
    for row in archives.collect():
        with open(row["archive"].removeprefix("file://"), "rb") as f:
            for headers, whole in warc.records(warc.inflated([f.read()])):
                assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n")
                assert {"warc-type", "warc-record-id", "warc-date", "content-length", "content-type", "warc-target-uri"} <= set(headers)
                assert headers["warc-record-id"].startswith("<urn:") and headers["warc-date"].endswith("Z")
                assert ("warc-profile" in headers) == ("warc-refers-to" in headers) == (headers["warc-type"] == "revisit")
                assert "\n" not in headers["warc-target-uri"]
                kinds[headers["warc-record-id"]] = headers["warc-type"]
    assert len(kinds) == 5 and sorted(kinds.values()) == ["response"] * 3 + ["revisit"] * 2
    read = warc.read_records(archives).collect()
    assert sorted((r["page_id"] or 0, str(r["url"])) for r in read) == sorted((p or 0, str(u)) for p, u, _ in data)


def test_broken_records_are_errors():
    for data in (b"HTTP/1.1 200\r\n\r\n", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort"):
        with pytest.raises(ValueError):
            list(warc.records([data]))
    assert list(warc.records([b"\r\n\r\n"])) == []
