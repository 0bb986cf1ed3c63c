"""WARC archives: written by Spark's text writer, read back as whole files, and assembled into one row per capture.

A capture is a `response` or `revisit` record; `request` and `metadata` records join it through WARC-Concurrent-To, in
whichever direction the link was written. Archives are gzip-compressed WARC/1.1 of at most `PER_FILE` captures each; the
writer's line end is the pair of CRLF that closes a record.

Defined results: NULL html is an empty payload, NULL url is left out; records that share an id are one record with their
number of `copies`; of several requests or metadata records of one capture the one with the smallest id is nested and
all are counted; records that join no capture are given by `unassembled`; empty archives give an empty table.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.functions.frames import skew_safe_lookup
from veilstone.llm.common import read_table, stored, work_path

#: Captures in one archive; each has three records.
PER_FILE = 2_000
LEAST_REVISIT = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORDS = (
    "archive string, offset long, record_id string, record_type string, concurrent_to array<string>, refers_to string, "
    "target_uri string, date string, payload_digest string, digest_ok boolean, payload_bytes long, payload binary"
)
CHUNK = 1 << 20


def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """`page_id`, `payload_digest` and `first_id` of the pages whose payload of at least `least` bytes also has a smaller
    page_id. Only ids and digests are shuffled, and the digests of more than a thousandth of the rows are spread."""
    html = F.coalesce("html", F.lit(""))
    digests = stored(
        pages.select("page_id", F.octet_length(html).alias("n"), F.sha2(html.cast("binary"), 256).alias("payload_digest")), "digests"
    ).where(F.col("n") >= least)
    counts = digests.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    counts = stored(counts.where("n > 1"), "equal")
    firsts = counts.select("payload_digest", "first_id")
    found = skew_safe_lookup(digests.select("page_id", "payload_digest"), firsts, counts, "payload_digest", "page_id")
    # NULL ids come after all others, so they revisit too
    return found.where("first_id IS NOT NULL AND NOT page_id <=> first_id").distinct()


def _header(name: str, value: Column) -> Column:
    """A header line, or NULL, which concat_ws leaves out; values keep to one line."""
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), "[\r\n]+", " "))


def _record(kind: str | Column, block: Column, *headers: Column) -> Column:
    length = _header("Content-Length", F.octet_length(block))
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), _header("WARC-Type", kind), *headers, length)
    return F.concat(head, F.lit("\r\n\r\n"), block)


def page_id_urn(page_id: str, digest: str, role: str) -> Column:
    shown = F.coalesce(F.col(page_id).cast("string"), F.lit("null"))
    return F.concat(F.lit("<urn:page:"), shown, F.lit(":"), F.substring(digest, 1, 32), F.lit(f":{role}>"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_REVISIT, per_file: int = PER_FILE) -> None:
    """A request, a response or revisit, and a metadata record for every row of `page_id`, `url` and `html`."""
    seen = revisits(pages, least).select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), "first_id")
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    rows = rows.join(seen, rows["page_id"].eqNullSafe(seen["_id"]) & (rows["digest"] == seen["_digest"]), "left")
    again = F.col("first_id").isNotNull()
    capture = page_id_urn("page_id", "digest", "capture")
    size = F.octet_length("html").cast("string")
    common = (_header("WARC-Date", F.lit(DATE)), _header("WARC-Target-URI", F.col("url")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    host = F.coalesce(F.regexp_extract("url", "^[a-z]+://([^/?#\r\n]*)", 1), F.lit(""))
    records = (
        _record(
            "request",
            F.concat(F.lit("GET / HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")),
            _header("WARC-Record-ID", page_id_urn("page_id", "digest", "request")),
            _header("WARC-Concurrent-To", capture),
            *common,
            _header("Content-Type", F.lit("application/http;msgtype=request")),
        ),
        _record(
            F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
            F.concat(http, F.when(again, F.lit("")).otherwise(F.col("html"))),
            _header("WARC-Record-ID", capture),
            *common,
            _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            F.when(again, _header("WARC-Profile", F.lit(REVISIT_PROFILE))),
            F.when(again, _header("WARC-Refers-To", page_id_urn("first_id", "digest", "capture"))),
            _header("Content-Type", F.lit("application/http;msgtype=response")),
        ),
        _record(
            "metadata",
            F.concat(F.lit("payload-bytes: "), size, F.lit("\r\n")),
            _header("WARC-Record-ID", page_id_urn("page_id", "digest", "metadata")),
            _header("WARC-Concurrent-To", capture),
            *common,
            _header("Content-Type", F.lit("application/warc-fields")),
        ),
    )
    lines = rows.select(F.concat_ws("\r\n\r\n", *records).alias("value"))
    # the line end closes the last record of a row
    lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def _inflated(blob: bytes) -> Iterator[bytes]:
    """Parts of the plain bytes; one gzip member or many, or no compression."""
    if blob[:2] != b"\x1f\x8b":
        yield from (blob[i : i + CHUNK] for i in range(0, len(blob), CHUNK))
        return
    rest = memoryview(blob)
    while rest:
        member, at = zlib.decompressobj(31), 0
        while not member.eof and at < len(rest):
            yield member.decompress(rest[at : at + CHUNK])
            at += CHUNK
        rest = rest[min(at, len(rest)) - len(member.unused_data) :] if member.eof else rest[len(rest) :]


def parsed(blob: bytes) -> Iterator[tuple[int, list[tuple[str, str]], bytes]]:
    """Offset in the plain bytes, headers and block of each record; holds no more than one record and a part."""
    parts, buffer, offset = _inflated(blob), bytearray(), 0

    def has(n: int) -> bool:
        while len(buffer) < n:
            part = next(parts, None)
            if part is None:
                return False
            buffer.extend(part)
        return True

    while True:
        start = 0
        while (end := buffer.find(b"\r\n\r\n", start)) < 0:
            start = max(0, len(buffer) - 3)
            if not has(len(buffer) + 1):
                if buffer.strip():
                    raise ValueError(f"record cut off at {offset}")
                return
        lines = buffer[:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {offset}")
        headers = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
        length = int(dict(headers)["content-length"])
        if not has(end + 4 + length):
            raise ValueError(f"record cut off at {offset}")
        yield offset, headers, bytes(buffer[end + 4 : end + 4 + length])
        has(end + 8 + length)
        used = min(len(buffer), end + 8 + length)
        del buffer[:used]
        offset += used


def _row(archive: str, offset: int, headers: list[tuple[str, str]], block: bytes, with_payload: bool) -> tuple:
    first: dict[str, str] = {}
    for k, v in headers:
        first.setdefault(k, v)
    kind = first.get("warc-type")
    is_http = first.get("content-type", "").startswith("application/http")
    payload = block[block.find(b"\r\n\r\n") + 4 :] if is_http else block
    given = re.sub("^sha256:", "", first["warc-payload-digest"]) if "warc-payload-digest" in first else None
    checked = hashlib.sha256(payload).hexdigest() == given if kind == "response" and given else None
    keep = with_payload or kind not in ("response", "request")
    return (
        archive, offset, first.get("warc-record-id"), kind, [v for k, v in headers if k == "warc-concurrent-to"],
        first.get("warc-refers-to"), first.get("warc-target-uri"), first.get("warc-date"), given, checked, len(payload),
        payload if keep else None,
    )


def read_records(spark: SparkSession, path: str, with_payload: bool = True, batch: int = 500) -> DataFrame:
    """Every record of the archives under `path`, with the digest of each response checked against its payload.
    Without payloads only those of metadata records are kept."""
    names = [x.strip().split(" ")[0] for x in RECORDS.replace("array<string>", "array").split(",")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, content in zip(frame["path"], frame["content"], strict=True):
                rows: list[tuple] = []
                for record in parsed(content):
                    rows.append(_row(archive, *record, with_payload))
                    if len(rows) == batch:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(read, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the capture's own columns, `copies`, `request` and `metadata` as structs of their
    record, and how many of each joined it."""
    fields = [c for c in records.columns if c not in ("archive", "offset")]
    is_capture = F.col("record_type").isin("response", "revisit")
    captures = records.where(is_capture).groupBy("record_id").agg(
        F.min_by(F.struct(*fields), F.struct("archive", "offset")).alias("capture"), F.count("*").alias("copies")
    )
    linked = _links(records).groupBy("capture_id").agg(
        *[
            f
            for kind in ("request", "metadata")
            for f in (
                F.min_by("record", F.when(F.col("record.record_type") == kind, F.col("record.record_id"))).alias(kind),
                F.count_distinct(F.when(F.col("record.record_type") == kind, F.col("record.record_id"))).alias(f"n_{kind}"),
            )
        ]
    )
    joined = captures.join(linked, captures["record_id"] == linked["capture_id"], "left")
    count = lambda kind: F.coalesce(F.col(f"n_{kind}"), F.lit(0)).alias(f"n_{kind}")
    return joined.select("capture.*", "copies", "request", "metadata", count("request"), count("metadata"))


def _links(records: DataFrame) -> DataFrame:
    """`capture_id` and the request or metadata record that belongs to it, by links of either direction."""
    others = records.where(F.col("record_type").isin("request", "metadata"))
    fields = F.struct(*[c for c in records.columns if c not in ("archive", "offset")]).alias("record")
    forth = others.select(F.explode("concurrent_to").alias("capture_id"), fields)
    back = records.where(F.col("record_type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("other_id")
    )
    return forth.unionByName(
        back.distinct().join(others.select("record_id", fields), F.col("other_id") == F.col("record_id")).select("capture_id", "record")
    )


def unassembled(records: DataFrame) -> DataFrame:
    """Records that are in no row of `assemble`: those that link to no capture and those beyond the nested ones."""
    made = assemble(records)
    used = made.select(F.explode(F.array("record_id", "request.record_id", "metadata.record_id")).alias("record_id"))
    return records.join(used.where("record_id IS NOT NULL").distinct(), "record_id", "left_anti")


def op3_warc_captures(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as archives to the shared folder, read back and assembled: a row per page."""
    path = work_path(spark, "warc")
    write_archives(read_table(spark, folder, "pages"), path)
    made = assemble(read_records(spark, path, with_payload=False))
    page = lambda c: F.regexp_extract(c, "^<urn:page:([0-9-]+):", 1).try_cast("long")
    told = F.regexp_extract(F.decode("metadata.payload", "UTF-8"), "payload-bytes: ([0-9]+)", 1).try_cast("long")
    return made.select(
        page("record_id").alias("page_id"),
        F.when(F.col("record_type") == "revisit", told).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
        "digest_ok",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")
