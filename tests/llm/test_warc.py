"""Archives: exact round trip, other writers' archives, links of either direction."""

from __future__ import annotations

import gzip
import hashlib

from veilstone.llm import warc

PAGE = "<p>" + "x" * 200 + "ü</p>"


def expected(pages):
    first = {}
    for i, _, html in pages:
        if i is not None:
            first[html] = min(i, first.get(html, i))
    out = []
    for i, _, html in pages:
        body = (html or "").encode()
        again = len(body) >= 100 and html in first and first[html] != i
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    return out


def test_round_trip_of_awkward_pages(run):
    pages = [
        (3, "http://a/1", PAGE), (1, None, PAGE), (2, "http://a/2\r\nX: y", PAGE), (2, "http://a/2\r\nX: y", PAGE), (4, "u", None), (5, "u", ""),
        (6, "u", "short"), (7, "u", "short"), (None, "u", PAGE), (8, "http://b/", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n" * 50),
        (9, "u", "long " * 300_000), (10, "u", "\r\n\r\n" * 30), (11, "u", "x" * 99), (12, "u", "x" * 99), (13, "u", "ü" * 50), (14, "u", "ü" * 50),
    ]
    rows = run("op3_warc_captures", pages=pages)
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(map(str, found)) == sorted(map(str, expected(pages)))
    assert all(r.digest_ok for r in rows if r.record_type == "response")
    assert run("op3_warc_captures") == []


def record(kind, ident, block, *more):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{ident}>", *more, f"Content-Length: {len(block)}"]
    return ("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    http = "Content-Type: application/http"
    members = [
        record("warcinfo", "info", b"software: x"),
        record("response", "r1", b"HTTP/1.1 200 OK\r\n\r\nbody", http, "WARC-Concurrent-To: <q1>", "WARC-Concurrent-To: <m1>"),
        record("request", "q1", b"GET / HTTP/1.1\r\n\r\n", http),
        record("metadata", "m1", b"a: b"),
        record("metadata", "m2", b"c: d", "WARC-Concurrent-To: <r1>"),
        record("request", "lost", b"GET / HTTP/1.1\r\n\r\n", http, "WARC-Concurrent-To: <none>"),
        record("response", "r2", b"HTTP/1.1 404\r\n\r\n", http),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, members)))
    (tmp_path / "b.warc").write_bytes(members[1])
    records = warc.read_records(spark, str(tmp_path))
    assert records.count() == 8
    made = {r.record_id: r for r in warc.assemble(records).collect()}
    assert set(made) == {"<r1>", "<r2>"}
    r1 = made["<r1>"]
    assert (r1.copies, r1.request.record_id, r1.n_request, r1.metadata.record_id, r1.n_metadata) == (2, "<q1>", 1, "<m1>", 2)
    assert bytes(r1.payload) == b"body" and r1.payload_bytes == 4 and made["<r2>"].request is None
    left = {r.record_id for r in warc.unassembled(records).collect()}
    assert left == {"<info>", "<m2>", "<lost>"}


def test_many_captures_of_one_payload(spark, tables, run):
    pages = [(i, "u", PAGE) for i in range(500)]
    rows = run("op3_warc_captures", pages=pages)
    assert sum(r.record_type == "response" for r in rows) == 1 and len(rows) == 500
